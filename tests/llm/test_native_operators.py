"""License scan, chat formatting, mixing: edge cases beside their SQL twins."""

import random

import pytest
from pyspark.sql import functions as F

from offerloom.llm import chat_format, license_scan, mixing
from offerloom.llm.queries import ORACLE, QUERIES
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, base, name):
    assert compare(QUERIES[name](spark, base), connect(base), ORACLE[name]) is None


@pytest.mark.parametrize("name", ["op4_exact_dedup", "op6_license_scan", "op7_chat_format", "op10_mixing"])
def test_native_plans_have_no_python(spark, base, name):
    plan = QUERIES[name](spark, base)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def scan(docs):
    return sorted(((r["doc_id"], r["n_words"], [tuple(p) for p in r["places"]], sorted(r["labels"]), round(r["score"], 3)) for r in license_scan.scan(docs).collect()), key=str)


def test_license_scan_edges(make_docs):
    filler = " ".join(["und"] * 100)
    rows = [
        (1, None), (2, ""), (3, "Released UNDER THE MIT LICENSE."), (4, "under the mit-license"), (5, "under the mité license"), (6, f"{filler} released, under: the MIT License {filler}"),
        (7, "Released under the terms of license MIT"), (8, "licence"), (9, "cc BY nc cc by nc"), (None, "apache license version 2"), (9, "cc BY nc cc by nc"),
    ]
    got = {str(r[0]) + str(r[1]): r for r in scan(make_docs(rows))}
    assert got["10"][1:] == (0, [], [], 0.0) and got["20"][1:] == (0, [], [], 0.0)
    assert got["35"][2] == [(1, "mit")] and got["35"][3] == ["mit"] and got["35"][4] == 1.0
    assert got["44"][2] == [(0, "mit")]
    assert got["54"][2] == []
    assert got["6205"][2] == [(101, "mit")] and got["6205"][3] == ["mit"]
    assert got["77"][2] == [] and got["77"][3] == ["mit"]  # found by the join alone
    assert got["81"][3] == [] and got["96"][2] == [(0, "cc-by-nc"), (3, "cc-by-nc")]
    assert got["None4"][2] == [(0, "apache-2")]
    assert len(scan(make_docs(rows))) == len(rows) and scan(make_docs(rows).limit(0)) == []


def test_license_join_finds_what_brute_force_finds(make_docs):
    rnd = random.Random(1)
    names = license_scan.vocabulary()
    rows = [(i, " ".join(rnd.choice(names + ["zz"] * 20) for _ in range(rnd.randint(0, 90)))) for i in range(150)]
    rows += [(1000 + i, " ".join(["zz"] * i + t.split()[: len(t.split()) - 1])) for i, (_, t) in enumerate(license_scan.TEMPLATES)]
    for id, _, _, labels, score in scan(make_docs(rows)):
        w = dict(rows)[id].split()
        blocks = [set(w[b : b + license_scan.BLOCK]) for b in range(0, max(len(w), 1), license_scan.BLOCK // 2)]
        parts = [(label, len(set(t.split()) & b) / len(set(t.split()))) for label, t in license_scan.TEMPLATES for b in blocks]
        met = [(label, p) for label, p in parts if p >= license_scan.THRESHOLD - 1e-9]
        assert labels == sorted({label for label, _ in met})
        if score < 1:
            assert score == round(max((p for _, p in met), default=0.0), 3)


BODY = """The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""


def test_license_scan_takes_whole_texts(make_docs):
    templates = [*license_scan.TEMPLATES, ("mit", f"{license_scan.TEMPLATES[1][1]} {BODY}"), ("own", "Free-for use!")]
    cut = license_scan.pieces(templates)
    assert cut[: len(license_scan.TEMPLATES)] == [(label, t.split()) for label, t in license_scan.TEMPLATES]
    assert all(len(t) <= license_scan.BLOCK // 2 for _, t in cut) and [w for _, t in cut[len(license_scan.TEMPLATES) : -1] for w in t] == license_scan.plain_words(templates[-2][1])
    docs = make_docs([(i, f"{'und ' * i} {BODY} und und") for i in range(40)] + [(100, "free for use, and more"), (101, "nothing")])
    got = {r["doc_id"]: r for r in license_scan.scan(docs, templates=templates, phrases={"And more": "more"}).collect()}
    assert all(got[i]["labels"] == ["mit"] and got[i]["score"] == 1 for i in range(40))
    assert got[100]["labels"] == ["own"] and [tuple(p) for p in got[100]["places"]] == [(3, "more")] and got[101]["labels"] == []
    bare = license_scan.scan(docs, templates=templates, phrases={}).collect()
    assert len(bare) == 42 and not any(r["places"] for r in bare)


CHATS = [
    (1, 1, "user", "hi <|end|> \\ \\<|turn|>"), (1, 0, "system", None), (1, 2, "assistant", "[INST] </s><s><<SYS>> <</SYS>>"), (1, 3, "assistant", "again\\"), (1, 4, "user", ""),
    (2, 0, None, "no role"), (2, 0, "assistant", "tie"), (2, None, "assistant", "no turn"), (None, 0, "user", "no conversation"), (3, 0, "assis<|x|>tant", "<"), (3, 1, "assistant", "|end|>"),
    (4, 0, "user", "twice"), (4, 0, "user", "twice"), (5, 0, "assistant", "é🙂" * 2000),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame([(*r, "clash") for r in CHATS], "conv_id long, turn long, role string, text string, formatted string")
    out = chat_format.format_chats(df).withColumns({
        "turns": chat_format.read_turns(F.col("formatted")), "loss": chat_format.read_loss(F.col("formatted"), F.col("loss_mask")),
    })
    rows = out.collect()
    assert len(rows) == 6
    for r in rows:
        said = [c[1:] for c in CHATS if c[0] == r["conv_id"]]
        said = sorted(((t, role or "", text or "") for t, role, text in said), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        assert [tuple(t) for t in r["turns"]] == [(role, text) for _, role, text in said]
        assert r["loss"] == "".join(text for _, role, text in said if role == "assistant")
        assert sum(m["skip"] + m["learn"] + m["rest"] for m in r["loss_mask"]) == len(r["formatted"])
        learned, at = "", 0
        for m in r["loss_mask"]:
            learned += r["formatted"][at + m["skip"] : at + m["skip"] + m["learn"]]
            at += m["skip"] + m["learn"] + m["rest"]
        assert "<|" not in learned.replace("<\\|", "") or r["conv_id"] == 3
    assert chat_format.format_chats(df.limit(0)).collect() == []


def test_adjacent_turns_share_a_message(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    assert chat_format.format_chats(df).first()["formatted"] == "<|start|>user<|message|>a<|turn|>b<|end|><|start|>assistant<|message|>c<|end|>"


def fill(sizes, share=mixing.SHARE, cap=mixing.CAP):
    """Targets by sharing the excess again and again."""
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    goal, full = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in sizes if s not in full]
        level = (goal - sum(full.values())) / max(1, sum(weight[s] for s in rest))
        over = [s for s in rest if level * weight[s] > cap * sizes[s]]
        if not over:
            return {s: full.get(s, level * weight[s]) for s in sizes}
        full |= {s: cap * sizes[s] for s in over}


def test_mixing_targets_and_copies(make_docs):
    rnd = random.Random(8)
    rows, id = [], 0
    for source, n in (("a", 200), ("b", 20), ("é", 90), ("Z", 5), (None, 40), ("", 3)):
        for _ in range(n):
            id += 1
            rows.append((id, " ".join("x" * rnd.randint(0, 60)), "en", source))
    rows += [(900, None, "en", "a"), (901, "", "en", "empty"), (902, None, "en", "empty"), (None, "no id here", "en", "a"), (903, "same row", "en", "b"), (903, "same row", "en", "b")]
    got = mixing.mix(make_docs(rows)).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mix(make_docs(rows).repartition(7)).collect()))
    source = {r[0]: r[3] for r in rows}
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    want = fill(sizes)
    taken = {}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(2 * 31, 0.02 * want[s])
    assert mixing.mix(make_docs(rows).limit(0)).collect() == []
    assert mixing.mix(make_docs([(1, None, "en", "a")])).first()["target"] == 0.0


def test_repeat_by_copies(make_docs):
    rows = [(i, "w " * (i + 1), "en", "s") for i in range(50)]
    mixed = mixing.mix(make_docs(rows), keep=("lang",))
    assert mixing.repeat_by_copies(mixed, ["doc_id", "lang"]).count() == mixed.agg(F.sum("copies")).first()[0]
