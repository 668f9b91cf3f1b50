"""Training-data operators: ten corpus operators and the queries over them.

Nothing else in the library imports this subpackage; it imports general helpers
(`tabforge.session`) only.
"""
