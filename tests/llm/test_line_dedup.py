from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tableferry.llm.line_dedup import drop_shared_lines

WHITE = " \t\n\x0b\f\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected(rows, at_least, min_chars=1):
    seen = Counter()
    for doc in set(rows):
        seen.update({lower(x.strip(WHITE)) for x in (doc[1] or "").split("\n")})
    shared = {k for k, n in seen.items() if n >= at_least and len(k) >= min_chars}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if lower(x.strip(WHITE)) not in shared]
        clean = text if len(kept) == len(lines) else "\n".join(kept)
        out.append((doc_id, clean, len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def got(df):
    found = df.select("doc_id", "text", "n_lines", "n_dropped").collect()
    return sorted((tuple(r) for r in found), key=repr)


CASES = [
    (1, "Same line\nown one"),
    (2, "  same LINE\t\nown two\n\n"),
    (3, "same line"),
    (3, "same line"),
    (4, None),
    (5, ""),
    (None, "same line\nÉ only"),
    (None, None),
    (6, "É shared\né shared\nx\r"),
    (7, "x\nX\nx"),
    (8, "word " * 30000 + "\nSAME LINE\n" + "tail"),
]


def test_cases(frame):
    assert got(drop_shared_lines(frame(CASES), min_documents=3)) == expected(CASES, 3)
    assert got(drop_shared_lines(frame(CASES), 2, 2)) == expected(CASES, 2, 2)


def test_no_rows(frame):
    assert got(drop_shared_lines(frame([]))) == []


def test_a_repeated_row_is_one_document(frame):
    rows = [(1, "a")] * 5 + [(2, "b")]
    assert got(drop_shared_lines(frame(rows), 2)) == expected(rows, 2)


def test_other_columns_stay(frame):
    rows = [(i, "a\nb", i, "p", i, "h") for i in range(4)]
    names = "doc_id long, text string, key long, line string, n_lines long, `a.b` string"
    df = drop_shared_lines(frame(rows, names), 3)
    assert set(df.columns) == {"doc_id", "text", "key", "line", "n_lines", "a.b", "n_dropped"}
    assert {(r["key"], r["line"], r["n_lines"], r["a.b"]) for r in df.collect()} == {
        (i, "p", 2, "h") for i in range(4)
    }


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.integers(0, 5),
            st.none() | st.text(alphabet="aAé \n\r", max_size=12),
        ),
        max_size=12,
    )
)
def test_against_brute_force(frame, rows):
    assert got(drop_shared_lines(frame(rows), 2)) == expected(rows, 2)
