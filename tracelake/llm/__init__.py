"""Operators on language-model texts. Nothing outside this subpackage imports it."""
