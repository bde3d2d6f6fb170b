"""Column expressions: typing rules, measures and links. All of them are Spark built-ins."""
