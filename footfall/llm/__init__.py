"""Operators for preparing training data, apart from the reports: nothing else imports this package."""
