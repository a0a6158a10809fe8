"""Folders of the test tables, for tests that read them.

A module of its own name: ``conftest`` is also the name of the fixtures of
sub-folders, so tests must not import from it.
"""

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"
