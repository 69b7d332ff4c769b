"""Column expressions: rights, submission fields, enumeration/chronology, MARC."""
