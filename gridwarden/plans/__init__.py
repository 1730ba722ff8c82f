"""The rules, the batch run and the report."""
