"""Column builders. All of them stay on the JVM side."""
