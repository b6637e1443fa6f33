"""Table operators: each is ``DataFrame -> DataFrame`` (or a predicate
``Column``) built from built-in Spark expressions."""
