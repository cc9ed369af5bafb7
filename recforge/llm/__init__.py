"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames, selects the columns it needs by name at its entry (extra
columns never clash) and treats a null text as empty unless it says otherwise.
"""
