"""Registered queries over the test tables and the independent SQL they are compared with."""
