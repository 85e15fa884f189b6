"""Column expressions shared by the jobs; all of them stay inside generated code."""
