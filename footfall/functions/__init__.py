"""Column expressions shared by the reports; all of them stay inside the JVM."""
