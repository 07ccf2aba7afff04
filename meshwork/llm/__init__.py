"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it; removing the folder leaves the
rest of the library working.
"""
