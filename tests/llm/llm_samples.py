"""Rows that the operators must handle."""

SF001 = "/root/testdata/sf0.001"
#: Nulls, empty, blank, repeated rows, equal texts under other ids, one very long text and odd characters.
ODD = [(1, None), (2, ""), (3, " \t\n\r\x0b\x0c"), (4, "one"), (5, "the same text in two rows"),
       (5, "the same text in two rows"), (6, "the same text in two rows"), (None, "no id here"), (None, None),
       (7, "a long story " * 30_000), (8, "x" * 5000), (9, "ÀÉ naïve 　 \x00 \x1c 字 ελ ΟΔΟΣ é <|endoftext|> 's 123"),
       (10, "word"), (10, "other words of the same id")]
