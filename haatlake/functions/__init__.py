"""Column expressions: everything here maps Column -> Column, no Python UDFs."""
