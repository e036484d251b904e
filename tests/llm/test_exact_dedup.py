import hashlib
import re
from collections import defaultdict

import pytest

from offerloom.llm import exact_dedup

BLANK = re.compile(r"[\x20\x09-\x0D]")


def plain(rows):
    groups = defaultdict(list)
    for id, text in rows:
        groups[BLANK.sub("", text or "")].append((id, text or ""))
    out = []
    for clean, members in groups.items():
        best = max(members, key=lambda m: (len(m[1]), m[0] is not None, -(m[0] or 0)))
        for id, text in members:
            out.append((id, best[0], len(members), id == best[0] and len(text) == len(best[1]), hashlib.sha256(clean.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [
    (1, "a b c"), (2, "abc"), (3, "a\tb\nc  "), (4, None), (5, ""), (6, " \x0b\x0c\r "), (7, "ab"), (8, "x" * 5000), (9, "x" * 5001), (10, "x" * 2500 + " " + "x" * 2500),
    (11, "x" * 4000), (12, "日本 語🙂"), (13, "日本語🙂"), (14, "c0"), (15, "h1"), (16, "0"), (None, "ab"), (None, "only null"), (17, "twice"), (17, "twice"), (18, "same id one"), (18, "same id two"),
    (19, "a b"), (20, "abcabcabc"), (21, "abcabc"), (22, "abcabcabcabc"),
]


@pytest.mark.parametrize("block", [2, 3, 1024])
def test_equals_plain_grouping(make_docs, block):
    got = exact_dedup.duplicates(make_docs(ROWS), block=block).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(ROWS)


def test_hot_block_and_hot_text(make_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 4)
    rows = [(i, "hot text" if i % 3 else f"text {i}") for i in range(60)]
    got = exact_dedup.duplicates(make_docs(rows), block=3).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


def test_empty_table(make_docs):
    assert exact_dedup.duplicates(make_docs(ROWS).limit(0)).collect() == []


def test_drop_keeps_rows_whole(make_docs):
    docs = make_docs(ROWS)
    left = exact_dedup.drop_duplicates(docs)
    assert left.columns == docs.columns
    want = sorted(str((r[0],)) for r in plain(ROWS) if r[3])
    assert sorted(str((r["doc_id"],)) for r in left.collect()) == want
    assert sorted(exact_dedup.BLANK_CHARS) == [chr(c) for c in (*range(9, 14), 32)]
