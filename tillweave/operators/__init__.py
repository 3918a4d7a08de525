"""Table operators shared by the plans."""
