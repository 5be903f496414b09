"""Column expressions shared by the silver and gold plans. All of them stay in the JVM."""
