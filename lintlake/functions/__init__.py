"""Column → Column building blocks; everything here stays inside the JVM."""
