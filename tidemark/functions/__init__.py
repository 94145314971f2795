"""Column expressions shared by staging and marts."""
