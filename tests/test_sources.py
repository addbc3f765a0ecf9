import pytest

from duoscope.plans import pipeline as X
from duoscope.sources import catalogs as S

LEFT_CSV = (
    'Series_Title,Released_Year,Genre,IMDB_Rating,No_of_Votes,Meta_score,Extra\n'
    '"  The Shawshank Redemption ",1994,Drama,9.3,2343110,80,x\n'
    '"Heat, the Movie",1995.7,"Action, Crime",8.3,100000,NA,x\n'
    'Apollo 13,PG,"Adventure",7.6,5000001,,x\n'
    '"Say ""Hi""",,Comedy,NA,0,"",x\n'
    '"Multi\nLine",2001, Comedy ,8.0,,77,x\n'
    'Heat,1995,Drama,8.0,500000,NA,x\n'
)
RIGHT_CSV = (
    'movie_title,original_release_date,genres,tomatometer_rating,audience_rating,'
    'tomatometer_count,tomatometer_status,tomatometer_fresh_critics_count,tomatometer_rotten_critics_count\n'
    'The Shawshank Redemption,1994-10-14,Drama,91,98,78,Certified-Fresh,71,7\n'
    '"Heat, the Movie",1995-12-15,Action,87,NA,19,Fresh,1,1\n'
    'Heat,1995-01-01,Drama,NA,80,20,Rotten,1,1\n'
    'Heat,bad date,Drama,50,80,,Rotten,1,1\n'
    'Multi Line,2001-05-05,Comedy,0,,20,weird,1,1\n'
)


@pytest.fixture()
def paths(tmp_path):
    a, b = tmp_path / "left.csv", tmp_path / "right.csv"
    a.write_text(LEFT_CSV)
    b.write_text(RIGHT_CSV)
    return str(a), str(b)


def test_reader_cases(spark, paths):
    a = S.read_catalog_a(spark, paths[0]).collect()
    assert len(a) == 6
    assert a[0].title == "The Shawshank Redemption" and a[0].rating_a == 9.3
    assert a[1].title == "Heat, the Movie" and a[1].year_text == "1995.7" and a[1].meta_score is None
    assert a[2].year_text == "PG" and a[2].votes == 5000001.0 and a[2].meta_score is None
    assert a[3].title == 'Say "Hi"' and a[3].year_text is None and a[3].rating_a is None
    assert a[3].meta_score is None  # quoted empty is missing too
    assert a[4].title == "Multi\nLine" and a[4].genre_list == "Comedy" and a[4].votes is None
    b = S.read_catalog_b(spark, paths[1]).orderBy("b_id").collect()
    assert [r.n_reviews for r in b] == [78, 19, 20, None, 20]
    assert b[1].score_c is None and b[2].score_b is None
    assert [r.b_id for r in b] == sorted(r.b_id for r in b)


def test_missing_path_names_the_source(spark, tmp_path):
    with pytest.raises(S.SourceNotFoundError, match="left catalogue not found"):
        S.read_catalog_a(spark, str(tmp_path / "nope.csv"))


def test_full_run_on_csv(spark, paths):
    a = S.read_catalog_a(spark, paths[0])
    b = S.read_catalog_b(spark, paths[1])
    cfg = X.RunConfig(enforce_gate=False)
    res = X.run(a, b, cfg)
    data = res["data"]
    got = sorted((r.title, r.year, r.match_type, r.b_norm) for r in data.collect())
    # cleaning drops 'PG' and the NULL rating; right drops the NULL tomatometer row
    assert ("The Shawshank Redemption", 1994, "exact", 9.1) in got
    assert ("Heat, the Movie", 1995, "exact", 8.7) in got
    assert res["checks"]["duplicates"] == 0
    assert {r.vote_bucket for r in data.collect()} >= {">1M", "<100k"}


def test_gate_enforced_raises_on_duplicates(spark, tmp_path):
    from duoscope.operators.quality import QualityGateError
    left = tmp_path / "l.csv"
    right = tmp_path / "r.csv"
    left.write_text(LEFT_CSV.splitlines()[0] + "\nHeat,1995,Drama,8.0,500000,NA,x\n")
    right.write_text(RIGHT_CSV.splitlines()[0] + "\nHeat,1995-01-01,Drama,60,80,20,Rotten,1,1\n"
                     "Heat,1995-02-01,Drama,70,80,20,Rotten,1,1\n")
    with pytest.raises(QualityGateError):
        X.run(S.read_catalog_a(spark, str(left)), S.read_catalog_b(spark, str(right)), X.RunConfig())


def test_rows_of_several_files_keep_path_order(spark, tmp_path):
    """Spark packs files by size; the order column follows paths all the same."""
    head = RIGHT_CSV.splitlines()[0]
    for name, n in (("a1", 1), ("a2", 400), ("a 3%", 30)):
        body = "".join(f"Heat,1995-01-01,Drama,{i % 100},80,20,{name}-{i},1,1\n" for i in range(n))
        (tmp_path / f"{name}.csv").write_text(head + "\n" + body)
    want = [f"{n}-{i}" for n, k in (("a 3%", 30), ("a1", 1), ("a2", 400)) for i in range(k)]
    for path in (str(tmp_path), f"{tmp_path}/*.csv", f"file:{tmp_path}"):
        rows = S.read_catalog_b(spark, path).orderBy("b_id").collect()
        assert [r.status for r in rows] == want
    rows = S.read_catalog_b(spark, str(tmp_path), multi_line=False).orderBy("b_id").collect()
    assert [r.status for r in rows] == want


def test_the_first_row_of_the_first_file_wins_a_tie_before_and_after_conversion(spark, tmp_path):
    head = RIGHT_CSV.splitlines()[0]
    for name, n in (("a1", 1), ("a2", 300), ("a3", 20)):
        body = "".join(f"Heat{'XYZ'[i % 3]},1995-01-01,Drama,{i % 100},80,20,{name},1,1\n" for i in range(n))
        (tmp_path / f"{name}.csv").write_text(head + "\n" + body)
    left = tmp_path / "left.csv"
    left.write_text(LEFT_CSV.splitlines()[0] + "\nHeatQ,1995,Drama,8.0,500000,NA,x\n")
    a = S.read_catalog_a(spark, str(left))
    b = S.read_catalog_b(spark, f"{tmp_path}/a*.csv")
    pq = S.convert_to_parquet(b, str(tmp_path / "right.parquet"))
    cfg = X.RunConfig(max_dist=0.3)
    from_csv = X.run(a, b, cfg)["data"].collect()
    from_pq = X.run(a, S.read_catalog_b(spark, pq, fmt="parquet"), cfg)["data"].collect()
    assert [r.status for r in from_csv] == ["a1"]
    assert sorted(map(str, from_csv)) == sorted(map(str, from_pq))


def test_parquet_round_trip(spark, paths, tmp_path):
    raw = S._csv_reader(spark).csv(paths[0])
    out = S.convert_to_parquet(raw, str(tmp_path / "left.parquet"))
    from_csv = sorted((r.title, r.year_text, r.rating_a) for r in S.read_catalog_a(spark, paths[0]).collect())
    from_pq = S.read_catalog_a(spark, out, fmt="parquet").collect()
    assert len(from_pq) == len(from_csv)
    assert {r.year_text for r in from_pq} >= {"1994", "PG"}
    assert sum(r.rating_a is None for r in from_pq) == 1  # 'NA' stayed missing, typed by try_cast


def _awkward_csv(rng, n, newline="\n"):
    """Records with quotes, commas, line breaks and blank lines inside quotes; blank lines between."""
    rows = ["id,text,other column"]
    for i in range(n):
        kind = rng.randrange(9)
        text = {0: f"plain {i}", 1: f'"a, b {i}"', 2: f'"line {i}{newline}next, ""said"" he{newline}{newline}end"',
                3: '""', 4: "NA", 5: f'"{newline}"', 6: f'"""{i}"""', 7: f"  padded {i} ",
                8: '"' + newline.join(f"row {j}" for j in range(rng.randrange(40))) + '"'}[kind]
        rows.append(f"{i},{text},{rng.choice(['', 'x', '“é”', 'z' * 200])}")
        if rng.random() < 0.1:
            rows.append("")
    return newline.join(rows) + rng.choice(["", newline])


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_byte_ranges_read_what_one_task_reads(spark, tmp_path, newline):
    import random
    rng = random.Random(len(newline))
    (tmp_path / "d").mkdir()
    for name, n in (("b.csv", 3000), ("a.csv", 40), ("c.csv", 1)):
        (tmp_path / "d" / name).write_bytes(_awkward_csv(rng, n, newline).encode())
    # one field over several ranges
    (tmp_path / "d" / "e.csv").write_bytes(newline.join(
        ["id,text,other column", '7,"' + newline.join(["long, line"] * 9000) + '",x', "8,after,y"]).encode())
    columns = {"id": ("id", "string"), "text": ("text", "string"), "other": ("other column", "string")}
    path = str(tmp_path / "d")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        want = S.read_catalog(spark, path, columns, "x", order_col="o", multi_line=True).orderBy("o").collect()
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        got = S.read_catalog(spark, path, columns, "x", order_col="o")
        assert sorted(got.collect(), key=lambda r: r.o) == want and len(want) > 3000
        from duoscope.sources.quoted import _lines
        one = _lines(spark, str(tmp_path / "d" / "b.csv"))
        assert one.rdd.getNumPartitions() >= 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_file_without_an_end_is_named(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('id,text\n1,"open\n2,x\n')
    with pytest.raises(ValueError, match="odd number of quotes in .*odd.csv"):
        S.read_catalog(spark, str(tmp_path / "odd.csv"), {"id": ("id", "string")}, "x")


def test_header_only(spark, tmp_path):
    (tmp_path / "h.csv").write_text("id,text\n")
    assert S.read_catalog(spark, str(tmp_path / "h.csv"), {"id": ("id", "string")}, "x", order_col="o").count() == 0
