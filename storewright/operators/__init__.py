"""DataFrame in, DataFrame out. Lazy: no operator here runs a Spark job."""
