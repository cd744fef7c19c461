"""Where the tests' tables are."""

SMALL = "/root/testdata/sf0.001"
