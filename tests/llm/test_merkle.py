import hashlib
import random

from pyspark.sql import functions as F

from duoscope.llm import merkle
from tests.llm.util import ODD, frame


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, fanout):
    """Top of a list of digests, and each one's [(left, right)] by level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, p in enumerate(at):
            run = p // fanout * fanout
            paths[i].append(("".join(level[run:p]), "".join(level[p + 1:run + fanout])))
            at[i] = p // fanout
        level = [h(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
    return level[0], paths


def brute(rows, fanout):
    """rows of (doc_id, text, lang, source): sorted (doc_id, leaf, subroot, root, path)."""
    groups = {}
    for doc_id, text, lang, source in rows:
        leaf = h(field(doc_id), field(source), field(text))
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = {s: tree([x[2] for x in sorted(groups[s])], fanout) for s in names}
    root, above = tree([tops[s][0] for s in names], fanout)
    out = []
    for s, up in zip(names, above):
        out += [(x[3], x[2], tops[s][0], root, path + up) for x, path in zip(sorted(groups[s]), tops[s][1])]
    return sorted(out, key=repr)


def run(spark, rows, fanout):
    docs = frame(spark, rows)
    out = merkle.manifest(docs, merkle.leaf("doc_id", "source", "text"), F.col("source"), F.col("doc_id"),
                          fanout, doc_id=F.col("doc_id"))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "path"]
    return out


def collected(out):
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, [tuple(x) for x in r.path]) for r in out.collect()], key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, t, "en", "odd") for i, t in enumerate(ODD)]
    rows += [(i * 3, f"text {i}", "en", "hot") for i in range(300)]
    rows += [(7, "same id", None, "ties"), (7, "other text", None, "ties"), (7, "same id", None, "ties")]
    rows += [(None, "a", None, None), (None, None, None, None), (4, "b", None, None), (-2, "c", None, None)]
    rows += [(rng.randrange(50), f"x{rng.randrange(9)}", None, rng.choice(["é", "z", "Z", "", "~", "a", "hot"]))
             for _ in range(60)]
    rows += [(1, "y" * 1_000_000, None, "long")]
    rng.shuffle(rows)
    for fanout in (2, 3, 16):
        out = run(spark, rows, fanout)
        assert collected(out) == brute(rows, fanout)
    folded = out.select((merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"),
                        (merkle.fold(F.lit("0" * 64), F.col("path")) == F.col("root")).alias("bad"),
                        merkle.proof_text(F.col("path")).alias("proof"), "path").collect()
    assert all(r.ok and not r.bad and r.proof == "".join(a + b for a, b in r.path) for r in folded)


def test_many_groups_and_equal_rows(spark):
    rows = [(i, "t", "en", f"s{i:03d}") for i in range(70)] + [(5, "copy", None, "hot")] * 200
    assert collected(run(spark, rows, 4)) == brute(rows, 4)


def test_one_row_and_none(spark):
    rows = [(3, "only", "en", "s")]
    (row,) = run(spark, rows, 16).collect()
    assert row.leaf == row.subroot == row.root and row.path == []
    assert run(spark, [], 16).count() == 0

