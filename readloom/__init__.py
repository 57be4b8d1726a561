"""readloom: short-read DNA analytics as Spark DataFrame operators."""
