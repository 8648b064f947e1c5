"""Where the tests read their tables."""

SF = "/root/testdata/sf0.001"
