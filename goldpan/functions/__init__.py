"""Column expressions shared by the jobs; all run inside the JVM."""
