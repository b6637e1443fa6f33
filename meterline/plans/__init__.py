"""Batch jobs and the registered query set.

* ``preprocess`` – raw trips -> clean Parquet + funnel + sample (one scan)
* ``train``      – clean Parquet -> split -> models -> result tables
* ``combined``   – both in one process, four models (the full profile)
* ``catalog``    – every operator as a named ``(spark, sf_dir) -> DataFrame``
* ``oracle_sql`` – the DuckDB SQL twin of each catalog entry
"""
