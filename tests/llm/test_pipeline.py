import random

import corpus_pipeline as P
from duoscope.llm import decontaminate, minhash
from tests.llm.util import ODD, frame, prose, spaced
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_linechunks import brute as brute_lines
from tests.llm.test_minhash import brute as brute_groups

EN = "the of and tion ing that with which from have they this would there".split()


def write(spark, folder):
    rng = random.Random(12)
    bench = [("b1", " ".join(prose(rng, 40, 9999))), ("b2", "too short")]
    rows = []
    for i in range(80):
        lines = [" ".join(rng.choice(EN) + str(rng.randrange(50)) for _ in range(8)) for _ in range(rng.randrange(1, 12))]
        if i % 9 == 0:
            lines.insert(0, " ".join(bench[0][1].split()[5:25]))
        rows.append((i, "\n".join(lines), "en", f"s{i % 4}"))
    for i in range(0, 40, 4):
        w = rows[i][1].split(" ")
        w[len(w) // 2] = "changed"
        rows.append((200 + i, " ".join(w), "en", "copies"))
        rows.append((300 + i, rows[i][1], "en", None))
    rows += [(500 + i, t, None, "odd") for i, t in enumerate(ODD)]
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return bench


def test_each_stage_against_brute_force(spark, tmp_path):
    folder = str(tmp_path)
    bench = write(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    out = {}
    for name, stage in P.STAGES:
        out[name] = before = docs
        docs = stage(spark, docs, folder)
        if name != "mix":
            assert docs.columns == columns and docs.dtypes == before.dtypes
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    rows = {n: [(r.doc_id, r.text) for r in d.collect()] for n, d in out.items()}
    assert {i for i, t in rows["language"]} - {i for i, t in rows["lines"]} == {i for i, t in rows["language"] if not any(c.isalpha() for c in t or "")}
    lines = [(r.doc_id, r.text, r.n_chars) for r in out["near_duplicates"].collect()]
    assert sorted(lines) == sorted((i, t, len(t)) for i, t, *_ in brute_lines(rows["lines"]))
    near = {i for i, _, c in brute_groups(rows["near_duplicates"], 5, 80) if i == c}
    assert {i for i, _ in rows["benchmark"]} == near
    clean = {i for i, _, hit, _ in brute_hits(rows["benchmark"], bench) if not hit}
    assert {i for i, _ in rows["mix"]} == clean and len(clean) < len(near)
    assert sorted((r.doc_id, r.size) for r in docs.collect()) == sorted((i, len(spaced(t))) for i, t in rows["mix"])


def test_run_equals_the_stages(spark, tmp_path):
    folder = str(tmp_path)
    write(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in P.STAGES:
        docs = spark.createDataFrame((d := stage(spark, docs, folder)).collect(), d.schema)
    assert sorted(map(str, P.run(spark, folder).collect())) == sorted(map(str, docs.collect()))
    assert P.ORACLE_SQL is None and [n for n, _ in P.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "mix"]


def test_empty_documents(spark, tmp_path):
    folder = str(tmp_path)
    write(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    docs.write.parquet(f"{folder}/none/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{folder}/none/benchmark.parquet")
    assert P.run(spark, f"{folder}/none").count() == 0


def test_near_duplicates_are_judged_by_row(spark):
    """Null and repeated ids: one row of each group, no clean text lost with a copy."""
    rng = random.Random(5)
    a, b, c = (" ".join(prose(rng, 60, 9999)) for _ in range(3))
    near = a.replace(a.split()[30], "changed", 1)
    rows = [(None, a, "en", "s"), (None, a, "en", "t"), (5, a, "en", "s"), (6, near, "en", "s"),        # one group
            (7, b, "en", "s"), (7, b, "en", "s"), (7, b, "en", "r"),                                   # equal in id and text
            (9, a, "en", "s"), (9, c, "en", "s"),                                                      # one copy, one clean
            (1, "", "en", "s"), (1, "", "en", "s"), (None, None, "en", "s"), (None, "  ", "en", "s")]
    for parts in (1, 5):
        docs = frame(spark, rows).repartition(parts)
        out = P.drop_near_duplicates(spark, docs, "")
        assert out.columns == docs.columns
        got = sorted(((r.doc_id, r.text, r.source) for r in out.collect()), key=str)
        assert got == sorted([(5, a, "s"), (7, b, "r"), (9, c, "s"), (1, "", "s"), (1, "", "s"), (None, None, "s"),
                              (None, "  ", "s")], key=str)
    only_null = frame(spark, [(None, b, "en", "s"), (None, b + " more", "en", "s"), (None, c, "en", "s")])
    assert P.drop_near_duplicates(spark, only_null, "").count() == 2
