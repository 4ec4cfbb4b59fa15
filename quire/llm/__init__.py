"""Operators for preparing training corpora, one module per operator.

Nothing else in the library imports this subpackage; the modules here may
use the library's general helpers.
"""
