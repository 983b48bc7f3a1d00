"""Operators that turn raw web documents into training data.  Nothing else in the package imports this one."""
