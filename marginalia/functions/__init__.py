"""Column -> Column functions, kept inside whole-stage code generation wherever Spark can express them."""
