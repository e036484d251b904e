import numpy as np

from offerloom.llm import language_id
from offerloom.llm.queries import QUERIES


def test_held_out_accuracy(spark, base):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op8_language_id"](spark, base).collect()
    import zlib

    assert len(got) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"]]
    assert sum(held) >= 0.95 * len(held)


def test_edges(make_docs):
    en, de = "the quick brown fox jumps over the lazy dog " * 5, "der schnelle braune fuchs springt über den faulen hund " * 5
    rows = [(i, en, "en", "s") for i in range(6)] + [(i, de, "de", "s") for i in range(6, 10)] + [(10, None, "en", "s"), (11, "", "en", "s"), (12, "123 !?", None, None), (13, "xq", None, "s"), (None, "der fuchs springt über den hund", "en", "s"), (13, "xq", None, "s")]
    model = language_id.fit(make_docs(rows))
    assert model.names == ["en", "de"]
    out = language_id.predict(make_docs(rows), model).collect()
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in out}
    assert len(out) == len(rows)
    assert all(got[i, en][0] == "en" for i in range(6)) and all(got[i, de][0] == "de" for i in range(6, 10))
    assert got[10, None] == got[11, ""] == got[12, "123 !?"] == ("und", 0.0)
    assert got[13, "xq"] == ("en", 0.0)  # letters, but no gram known: the commonest language
    assert got[None, "der fuchs springt über den hund"][0] == "de"
    nothing = language_id.fit(make_docs(rows).limit(0))
    assert nothing.names == [] and {r["lang_pred"] for r in language_id.predict(make_docs(rows), nothing).collect()} == {"und"}
    assert language_id.predict(make_docs(rows).limit(0), model).collect() == []


def test_grams_stay_within_texts_and_runs():
    apart = [language_id.grams([t])[0].tolist() for t in ("hello world", "x", "", "straße und")]
    together, owner, has = language_id.grams(["hello world", "x", "", "straße und"])
    assert [together[owner == i].tolist() for i in range(4)] == apart and has.tolist() == [True, True, False, True]


def test_more_languages_than_a_mask_holds():
    grams = {f"l{i:03}": np.arange(i * 50, i * 50 + 50).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in range(70)}
    model = language_id.Filters(sorted(grams), grams)
    for name in ("l003", "l064", "l069"):
        counts = model.counts(grams[name], np.zeros(50, dtype=np.int64), 1)[0]
        assert model.names[int(np.argmax(counts))] == name and counts.max() > 49


def test_counts_are_corrected_for_mistakes():
    rng = np.random.default_rng(0)
    own = rng.integers(0, 2**63, size=60_000).astype(np.uint64)
    model = language_id.Filters(["a"], {"a": own})
    strange = rng.integers(0, 2**63, size=20_000).astype(np.uint64)
    assert model.mistake[0] > 0.05 and abs(model.counts(strange, np.zeros(20_000, dtype=np.int64), 1)[0, 0]) < 600
