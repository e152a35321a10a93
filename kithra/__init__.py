"""Vector and text similarity analytics as Spark DataFrame operators."""
