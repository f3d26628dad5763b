"""Column expressions shared by every operator. All of them stay in the JVM."""
