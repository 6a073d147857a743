"""Part of the docket engine."""
