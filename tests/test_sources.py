import gzip

import pytest
from pyspark.sql import functions as F

from playrank.session import materialize, shared_dir
from playrank.sources.cleaning import build_catalog, load_events, load_games, minimal_catalog
from playrank.sources.literal_lines import GAME_SCHEMA, REVIEW_SCHEMA, numbered_lines, read_literal_lines
from playrank.sources.prepare import prepare_files
from playrank.sources.tables import export_serving, insert_missing, published_batches, read_catalog, read_export, read_splits, serving_tables, split_row_counts

GOOD = [
    {"username": "ann", "product_id": "7", "date": "2017-01-02", "hours": 1.5, "text": "It's \"good\"\n", "early_access": True, "products": 3},
    {"username": "bob", "product_id": "7", "date": "2017-01-03", "hours": "0.2", "text": None, "compensation": "Product received for free"},
    {"username": "ann", "product_id": "7", "date": "2017-02-02", "hours": 9},
    {"username": "", "product_id": "7", "date": "2017-01-03", "hours": 1},
    {"username": "cat", "product_id": "8", "date": "not a date", "hours": 1},
    {"username": "cat", "product_id": "9", "date": "2017-01-03", "hours": "many"},
    {"username": "cat", "product_id": "10", "date": "2017-01-03", "hours": -1},
]


def write(path, lines):
    with gzip.open(path, "wb") as out:
        out.write(b"\n".join(line if isinstance(line, bytes) else line.encode() for line in lines))
    return str(path)


def test_lines_are_parsed_and_cleaned(spark, tmp_path):
    path = write(tmp_path / "r.json.gz", ["", *[repr(r) for r in GOOD], "   "])
    raw = read_literal_lines(spark, path, REVIEW_SCHEMA)
    assert raw.count() == len(GOOD)
    assert raw.where("username = 'ann' and date = '2017-01-02'").first()["text"] == GOOD[0]["text"]
    rows = {(r["user_id"], r["item_id"]): r for r in load_events(raw).collect()}
    assert set(rows) == {("ann", "7"), ("bob", "7")}
    assert rows["ann", "7"]["hours"] == 9.0 and rows["ann", "7"]["is_positive"]
    assert not rows["bob", "7"]["is_positive"] and rows["bob", "7"]["received_for_free"]
    assert rows["bob", "7"]["text_length"] == 0 and rows["bob", "7"]["found_funny"] == 0.0


def test_failfast_names_file_and_line(spark, tmp_path):
    path = write(tmp_path / "bad.json.gz", [repr(GOOD[0]), "{'username': broken"])
    with pytest.raises(Exception, match="bad.json.gz line 2: .*broken"):
        read_literal_lines(spark, path, REVIEW_SCHEMA).collect()


@pytest.mark.parametrize("split_bytes", ["100", "1000", "100000"])
def test_lines_are_numbered_across_splits(spark, tmp_path, split_bytes):
    """Plain files are cut into splits, gzip files are one each; blank lines count too."""
    texts = {f"f{k}.txt": [f"{k} {n} {'x' * (n * 7 % 50)}" if n % 5 else "" for n in range(60 + k)] for k in range(3)}
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    write(tmp_path / "g.gz", texts["f0.txt"])
    texts["g.gz"] = texts["f0.txt"]
    conf = {"spark.sql.files.maxPartitionBytes": split_bytes, "spark.sql.files.openCostInBytes": "1"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        rows = numbered_lines(spark, str(tmp_path)).collect()
        bad = [*[repr(GOOD[0])] * 40, "", "{'username': broken", repr(GOOD[0])]
        (tmp_path / "bad").mkdir()
        (tmp_path / "bad" / "b.txt").write_text("\n".join(bad))
        with pytest.raises(Exception, match="b.txt line 42: "):
            read_literal_lines(spark, str(tmp_path / "bad"), REVIEW_SCHEMA).collect()
    finally:
        for key in conf:
            spark.conf.unset(key)
    if split_bytes == "100":
        assert len({(r["_source"], r["_block"]) for r in rows}) > 40
    found = {}
    for r in rows:
        found.setdefault(r["_source"].rsplit("/", 1)[1], []).append((r["_line"], r["value"]))
    assert {name: sorted(lines) for name, lines in found.items()} == {name: list(enumerate(lines, 1)) for name, lines in texts.items()}


def test_permissive_keeps_the_bad_line(spark, tmp_path):
    path = write(tmp_path / "bad.json.gz", [repr(GOOD[0]), "{'username': broken", "[1, 2]"])
    rows = read_literal_lines(spark, path, REVIEW_SCHEMA, "PERMISSIVE").collect()
    assert sorted(r["_corrupt_record"] or "" for r in rows) == ["", "[1, 2]", "{'username': broken"]


def test_undecodable_bytes_are_replaced(spark, tmp_path):
    path = write(tmp_path / "b.json.gz", [b"{'username': 'a\xff', 'product_id': '1'}"])
    assert read_literal_lines(spark, path, REVIEW_SCHEMA).first()["username"] == "a�"


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="unknown mode"):
        read_literal_lines(spark, "x", REVIEW_SCHEMA, "LOUD")


def test_games(spark, tmp_path):
    lines = [
        {"id": "1", "title": "", "app_name": "One", "genres": ["A", "B"], "tags": ["t"], "price": 4.5, "release_date": "2015-06-01", "early_access": True},
        {"id": "1", "title": "One again", "genres": [], "tags": ["t", "u"], "price": "Free", "release_date": "soon"},
        {"title": "no id"},
        {"id": "2"},
    ]
    path = write(tmp_path / "g.json.gz", [repr(r) for r in lines])
    games = {r["item_id"]: r for r in load_games(read_literal_lines(spark, path, GAME_SCHEMA)).collect()}
    assert set(games) == {"1", "2"}
    one, two = games["1"], games["2"]
    assert (one["title"], one["category"], one["genres"], one["tags"], one["price"], one["release_date"]) == ("One again", "t", "", "t|u", None, None)
    assert (two["title"], two["category"], two["early_access_item"]) == ("Steam app 2", "Unknown", False)


def test_the_last_line_of_the_last_file_wins(spark, tmp_path):
    """However large the files are: Spark packs the larger one first."""
    old = [repr({"id": "1", "title": "old"}), repr({"id": "2", "title": "only"})]
    filler = [repr({"id": str(n), "title": "x" * 200}) for n in range(100, 400)]
    write(tmp_path / "a.json.gz", old)
    write(tmp_path / "b.json.gz", [*filler, repr({"id": "1", "title": "new"})])
    write(tmp_path / "c.json.gz", [repr({"id": "3", "title": "third"}), repr({"id": "3", "title": "third again"})])
    games = {r["item_id"]: r["title"] for r in load_games(read_literal_lines(spark, str(tmp_path), GAME_SCHEMA)).collect()}
    assert (games["1"], games["2"], games["3"]) == ("new", "only", "third again")


def test_catalog_defaults(spark):
    seen = spark.createDataFrame([("1",), ("1",), ("3",)], "item_id string")
    games = spark.createDataFrame([("1", "One", "A"), ("2", "Two", "B")], "item_id string, title string, category string")
    rows = {r["item_id"]: r for r in build_catalog(seen, games).collect()}
    assert set(rows) == {"1", "3"}
    assert (rows["3"]["title"], rows["3"]["category"]) == ("Steam app 3", "Unknown")
    assert rows["1"]["image_url"].endswith("/1/header.jpg")
    assert {r["title"] for r in minimal_catalog(seen).collect()} == {"Game 1", "Game 3"}


def test_export_inserts_only_what_is_missing(spark, tmp_path):
    train = spark.createDataFrame([(1, 10), (1, 11)], "user_id int, item_id int").withColumn("event_time", F.make_timestamp_ntz(F.lit(2020), F.lit(1), "item_id", F.lit(0), F.lit(0), F.lit(0)))
    test = spark.createDataFrame([(2, 10, 1.0), (1, 12, 3.0)], "user_id int, item_id int, hours double").withColumn("event_time", F.lit("2021-01-01").cast("timestamp_ntz"))
    catalog = spark.createDataFrame([(10, "t", "c", "u")], "item_id int, title string, category string, image_url string")
    path, tables = str(tmp_path), serving_tables(train, test, catalog)
    for batch in ("one", "one", "two"):
        export_serving(tables, path, batch)
    table = lambda name: read_export(spark, path, name)
    assert {n: table(n).count() for n in ("users", "items", "interactions")} == {"users": 2, "items": 1, "interactions": 4}
    created = {r["user_id"]: str(r["created_at"]) for r in table("users").collect()}
    assert created == {1: "2020-01-10 00:00:00", 2: "2021-01-01 00:00:00"}
    assert sorted(r["id"] for r in table("interactions").collect()) == [1, 2, 3, 4]
    assert insert_missing(catalog, None, "item_id").count() == 1
    export_serving(tables, path)  # a batch without a name is a new one
    assert table("interactions").count() == 6 and len(published_batches(spark, path)) == 3
    with pytest.raises(ValueError, match="named by"):
        export_serving(tables, path, "../x")


def test_a_broken_export_leaves_nothing(spark, tmp_path):
    import os

    users = spark.createDataFrame([(1, "2020-01-01")], "user_id int, created_at string")
    items = spark.createDataFrame([(10, "t")], "item_id int, title string")
    good = spark.createDataFrame([(1, 10, "2020-01-01")], "user_id int, item_id int, event_time string")
    broken = good.withColumn("event_time", F.raise_error(F.lit("lost")).cast("string"))
    path = str(tmp_path / "export")
    assert read_export(spark, path, "users") is None
    with pytest.raises(Exception, match="lost"):
        export_serving({"users": users, "items": items, "interactions": broken}, path, "one")
    assert published_batches(spark, path) == [] and read_export(spark, path, "users") is None
    assert not [f for _, _, files in os.walk(path) for f in files]
    # Parts of a batch whose driver died are not read and are replaced by the next try.
    users.write.parquet(os.path.join(path, "users", "one"))
    users.write.mode("append").parquet(os.path.join(path, "users", "one"))
    assert read_export(spark, path, "users") is None
    export_serving({"users": users, "items": items, "interactions": good}, path, "one")
    assert [read_export(spark, path, n).count() for n in ("users", "items", "interactions")] == [1, 1, 1]


def test_prepare_from_files(spark, tmp_path):
    reviews = [{"username": f"u{n % 7}", "product_id": str(n % 11), "date": f"2017-{1 + n % 12:02d}-{1 + n % 28:02d}", "hours": n % 5} for n in range(200)]
    games = [{"id": str(n), "title": f"t{n}", "genres": ["G"]} for n in range(6)]
    raw = write(tmp_path / "r.json.gz", [repr(r) for r in reviews]), write(tmp_path / "g.json.gz", [repr(g) for g in games])
    prepare_files(spark, *raw, str(tmp_path / "all"))
    counts = {r["split"]: r["rows"] for r in split_row_counts(spark, str(tmp_path / "all")).collect()}
    assert counts == {"train": 54, "validation": 7, "test": 16}  # 77 different pairs
    catalog = {r["item_id"]: r["title"] for r in read_catalog(spark, str(tmp_path / "all")).collect()}
    assert len(catalog) == 11 and catalog["0"] == "t0" and catalog["10"] == "Steam app 10"
    prepare_files(spark, *raw, str(tmp_path / "capped"), max_rows=50)
    rows = read_splits(spark, str(tmp_path / "capped"))
    assert rows.count() == 50
    assert rows.agg(F.min("event_time")).first()[0] >= read_splits(spark, str(tmp_path / "all")).agg(F.min("event_time")).first()[0]
    assert spark.read.json(str(tmp_path / "capped" / "data_summary" / "json")).first()["interactions"] == 50


def test_intermediate_tables_go_to_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    assert all(f.startswith(f"file://{configured}") for f in materialize(spark.range(3), "x").inputFiles())
