"""Home-advantage analytics for basketball game logs, written as Spark DataFrame jobs."""
