"""Operators over translation units: gate rules, contracts, validation, plans, evidence and workflow."""
