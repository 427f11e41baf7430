"""Operators for preparing training corpora. Nothing else in harrow imports this subpackage."""
