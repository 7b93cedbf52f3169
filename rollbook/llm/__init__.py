"""Operators for building training corpora at scale.  Nothing else in the library
imports this subpackage, so it can be removed as a whole."""
