"""What tests are given: the smallest tables, and a log worked by hand."""

TESTDATA = "/root/testdata/sf0.001"

GOLDEN = [
    ("1", "10", "100", "pv", 0),
    ("1", "10", "100", "buy", 86400),
    ("1", "9", "100", "cart", 172800),
    ("2", "10", "100", "fav", 86400),
    ("2", "9", "100", "buy", 259200),
    ("2", "11", "101", "cart", 0),
    ("3", "11", "101", "pv", 345600),
]
