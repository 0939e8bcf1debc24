from __future__ import annotations

from tableferry.llm.licenses import SENTENCES, scan_licenses

MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
AS_IS = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
# the licence paragraph must begin with a sentence of its own
MIT = MIT.replace("MIT License\n\n", "MIT License.\n\n")

CASES = [
    (1, "Some prose.\nLicensed under the Apache License, Version 2.0."),
    (2, "a line without an end\nReleased under the MIT License.\nmore"),
    (3, MIT + AS_IS),
    (4, MIT),
    (5, "Licensed under CC BY-NC 4.0. Then: released under the MIT license!"),
    (6, "nothing licensed under the apache license version 2.0 here"),
    (7, None),
    (8, ""),
    (9, "x " * 40000 + ". Licensed under CC BY-NC 4.0."),
    (10, "Licensed under CC BY-NC 4.0."),
    (10, "Licensed under CC BY-NC 4.0."),
    (None, "Licensed under CC BY-NC 4.0."),
]
EXPECTED = [
    (1, "Apache-2.0", 1, 1),
    (2, "MIT", 0, 1),
    (3, "MIT", 1, 3),
    (4, "MIT", 1, 2),
    (5, "CC-BY-NC-4.0", 0, 1),
    (5, "MIT", 2, 1),
    (9, "CC-BY-NC-4.0", 1, 1),
    (10, "CC-BY-NC-4.0", 0, 1),
    (10, "CC-BY-NC-4.0", 0, 1),
    (None, "CC-BY-NC-4.0", 0, 1),
]


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_cases(frame):
    assert got(scan_licenses(frame(CASES))) == sorted(EXPECTED, key=repr)


def test_no_rows_and_other_columns(frame):
    assert got(scan_licenses(frame([]))) == []
    odd = frame([(1, "Licensed under CC BY-NC 4.0.", "x")], "doc_id long, text string, key string")
    assert got(scan_licenses(odd)) == [(1, "CC-BY-NC-4.0", 0, 1)]


def test_order_matters(frame):
    sentences = {"one": "first sentence", "two": "second sentence"}
    rules = [("L", ["one", "two"])]
    rows = [(1, "First sentence. Between. Second sentence."), (2, "Second sentence. First sentence.")]
    assert got(scan_licenses(frame(rows), sentences, rules)) == [(1, "L", 0, 2)]


PLAIN_MIT = MIT.replace("MIT License.\n\n", "MIT License\n\nCopyright (c) 2020 Jane Doe\n\n")
WRAPPED = [
    (1, PLAIN_MIT + AS_IS),
    (2, PLAIN_MIT.replace("\n", "\r\n")),
    (3, "Title\nReleased under\n\n  the MIT\nLicense\nmore\nreleased\nunder the MIT license\nend"),
    (4, "Title\nReleased under\nthe MIT\nplain\nLicense\nend"),
    (5, "Released under\nthe MIT License."),
    (6, "the\n" * 3000 + "Released under\nthe MIT License."),
]


def test_wrapped_below_a_title(frame):
    found = got(scan_licenses(frame(WRAPPED)))
    assert found == [
        (1, "MIT", 0, 3), (2, "MIT", 0, 2), (3, "MIT", 0, 1), (3, "MIT", 0, 1), (5, "MIT", 0, 1),
        (6, "MIT", 0, 1),
    ]


def test_runs_that_overlap(frame):
    sentences = {"one": "a b a", "two": "b a b a"}
    rows = [(1, "x\na\nb\na\nb\na\ny")]
    assert got(scan_licenses(frame(rows), sentences, [("L", ["one"]), ("M", ["two"])])) == [
        (1, "L", 0, 1), (1, "L", 0, 1), (1, "M", 0, 1),
    ]


def test_sentences_are_normal():
    for text in SENTENCES.values():
        assert text == " ".join(text.lower().split())
