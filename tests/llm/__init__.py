"""Tests of the corpus operators (a package, so that its conftest does not hide the one above)."""
