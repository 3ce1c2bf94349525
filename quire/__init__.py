"""quire: text-reuse analytics as DataFrame-to-DataFrame operators on Spark."""
