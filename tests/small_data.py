"""Where the smallest test tables are; a module that no conftest can hide."""

SMALL_DATA = "/root/testdata/sf0.001"
