import hashlib
import random

from duoscope.llm import decontaminate as D
from tests.llm.util import ODD, alnum, frame, prose


def brute(docs, items, window=10):
    out = []
    for i, t in docs:
        w, hit, found = alnum(t), set(), set()
        for item, text in items:
            v = alnum(text)
            n = min(window, len(v))
            wins = {tuple(v[j:j + n]) for j in range(len(v) - n + 1)} if n else set()
            for a in range(len(w) - n + 1) if n else ():
                if tuple(w[a:a + n]) in wins:
                    hit |= set(range(a, a + n))
                    found.add(item or "")
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return out


def tables(spark):
    rng = random.Random(5)
    items = [(str(i), " ".join(prose(rng, rng.randrange(11, 60)))) for i in range(12)]
    items += [("short", "w1 w2 w3"), ("one", "Zq7"), ("none", "?!"), ("null", None), (None, "p q r s t u v w x y z a b c"),
              ("dup", items[3][1]), ("rep", "k k k k k k k k k k k k k k"), ("3", items[3][1])]
    rows = []
    for i in range(60):
        w = prose(rng, rng.randrange(5, 200))
        for _ in range(rng.randrange(3)):
            v = alnum(rng.choice(items[:12])[1])
            a = rng.randrange(len(v))
            at = rng.randrange(len(w))
            w[at:at] = v[a:a + rng.choice([4, 9, 10, 11, 30])]
        rows.append((i, " ".join(w).replace("w3 ", "W3, ")))
    rows += [(100 + i, t) for i, t in enumerate(ODD)]
    rows += [(200, "w1, w2 w3"), (201, "k " * 12), (202, "p q r s t u v w x y z a b c"), (203, "a b zq7 c"), (0, rows[0][1]), (None, "zq7")]
    rows += [(300, " ".join(prose(rng, 30000, 20000)) + " " + items[0][1])]
    bench = spark.createDataFrame(items, "item_id string, text string")
    return frame(spark, [(i, t, "en", "s") for i, t in rows]), bench, rows, items


def test_contamination_equals_brute_force_in_one_block_and_in_many(spark):
    docs, bench, rows, items = tables(spark)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = sorted(brute(rows, items), key=key)
    for block_bytes in (D.BLOCK_BYTES, 600):
        got = [(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in D.contamination(docs, bench, block_bytes=block_bytes).collect()]
        assert sorted(got, key=key) == want


def test_drop_keeps_all_columns_of_clean_rows(spark):
    docs, bench, rows, items = tables(spark)
    clean = D.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r[0]) for r in brute(rows, items) if not r[2])


def test_empty_tables(spark):
    docs, bench, _, _ = tables(spark)
    assert D.contamination(docs.limit(0), bench).count() == 0
    assert D.contamination(docs, bench.limit(0)).where("n_hit > 0 OR size(items) > 0").count() == 0
    assert D.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_digest_of_the_query(spark, tmp_path):
    from duoscope.llm.queries import op3_decontaminate

    docs, bench, rows, items = tables(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    want = {(i, hashlib.sha256(",".join(f).encode()).hexdigest(), len(f)) for i, _, _, f in brute(rows, items)}
    got = op3_decontaminate(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.items_sha256, r.n_items) for r in got} == want


def test_a_pass_holds_one_block(spark):
    """Many blocks of items: the same result, and one pass over the texts in the plan that is left."""
    rng = random.Random(8)
    items = [(f"i{n}", " ".join(prose(rng, 30, 9999))) for n in range(40)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    docs = frame(spark, [(n, " ".join(prose(rng, 20, 9999)) + " " + items[n][1], "en", "s") for n in range(0, 40, 3)]
                 + [(100, None, None, None), (101, "none", "en", "s")])
    one, many = D.contamination(docs, bench), D.contamination(docs, bench, block_bytes=400)
    assert many._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    clean = D.drop_contaminated(docs, bench, block_bytes=400)
    assert clean._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(r.doc_id for r in clean.collect()) == [100, 101]
