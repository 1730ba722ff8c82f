"""Chat formatting, decontamination, line dedup and WARC: edge cases by hand, whole tables against SQL or brute force."""

import base64
import glob
import gzip
import hashlib
import os
import random
import time
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from gridwarden.llm import chat, decontaminate, line_dedup, queries, topk, warc
from gridwarden.llm.common import shared_folder

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    result = queries.queries()[name](spark, SF_DIR)
    cursor = duck.execute(queries.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    columns = sorted(result.columns)
    assert columns == sorted(names)
    theirs = Counter(tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall())
    assert Counter(tuple(row) for row in result.select(columns).collect()) == theirs
    assert theirs


CHAT = "conv_id long, turn long, role string, text string, segments string"


def formatted(spark, rows):
    out = chat.read_chat(chat.format_chat(spark.createDataFrame(rows, CHAT))).collect()
    return {row.conv_id: row for row in out}


def test_chat_reads_back_control_strings_nulls_and_odd_roles(spark):
    texts = ["</s>[INST] ok [/INST]", "\\0 \\\\ <<SYS>> \\1", "", "[ROLE x]", "line\nbreak <|end|>"]
    rows = [(1, i, ["user", "assistant"][i % 2], text, "x") for i, text in enumerate(texts)]
    rows += [(2, 0, None, "a", "x"), (2, 1, "tool[]", None, "x"), (None, 0, "user", "n", "x")]
    out = formatted(spark, rows)
    assert [(t.role, t.text) for t in out[1].turns] == [(["user", "assistant"][i % 2], t) for i, t in enumerate(texts)]
    assert out[1].learned == [texts[1], texts[3]] and not out[1].valid
    assert [(t.role, t.text) for t in out[2].turns] == [("", "a"), ("tool[]", "")] and not out[2].valid
    assert [(t.role, t.text) for t in out[None].turns] == [("user", "n")]


def test_chat_orders_turns_and_checks_roles(spark):
    def one(*roles):
        return formatted(spark, [(1, i, role, "t", "") for i, role in enumerate(roles)])[1].valid

    assert one("system", "user", "assistant") and one("user", "assistant", "tool", "assistant")
    assert not one("assistant") and not one("user", "user", "assistant") and not one("user")
    tied = formatted(spark, [(1, 0, "user", "b", ""), (1, 0, "user", "a", ""), (1, None, "user", "c", ""), (1, 0, "user", "a", "")])
    assert [t.text for t in tied[1].turns] == ["c", "a", "a", "b"]
    assert formatted(spark, []) == {}


DOCS = "doc_id long, text string, hash long, spans string"


def test_decontamination_edges(spark):
    docs = spark.createDataFrame(
        [(1, "A b, c d. E!", 0, ""), (None, None, 0, ""), (2, "", 0, ""), (3, "x A B c d e f", 0, ""), (3, "x A B c d e f", 0, ""), (4, "É b x", 0, "")],
        DOCS,
    )
    items = spark.createDataFrame([(7, "b c"), (8, "C D e"), (9, "..."), (None, "é b"), (7, "b c")], "item_id long, text string")
    kept = decontaminate.decontaminate(docs, items).collect()
    assert {(r.doc_id, r.text) for r in kept} == {(None, None), (2, ""), (4, "É b x")}  # É is not lower-cased
    judged = {(r.doc_id, r.text): r for r in decontaminate.contamination(docs, items).collect()}
    assert [(s.begin, s.end) for s in judged[3, "x A B c d e f"].spans] == [(2, 6)]
    assert judged[3, "x A B c d e f"]["items"] == ["7", "8"]
    assert judged[None, None].spans is None and judged[2, ""].spans is None
    cut = decontaminate.decontaminate(docs, items, remove="spans").where("doc_id = 3").collect()
    assert [r.text for r in cut] == ["x A f"] * 2 and cut[0].hash == 0 and cut[0].spans == ""
    nothing = decontaminate.decontaminate(docs, items.limit(0))
    assert nothing.count() == 6 and nothing.columns == docs.columns
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0


def test_decontamination_in_parts_finds_the_same(spark):
    docs = spark.createDataFrame([(i, f"a{i} b{i} c d e f g h i j k l m n") for i in range(20)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "c d e f g h i j k l m"), (2, "a3 b3")], "item_id long, text string")
    windows = decontaminate.benchmark_windows(items)
    for bound in (1, 1000):
        found = decontaminate.scanned(docs, windows, bound).cache()
        assert found.where("first").count() == 20 and found.where("hash is not null").count() == 41
        assert sorted((r.key.doc_id, r["at"]) for r in decontaminate.verified(found, windows).collect()) == sorted(
            [(i, at) for i in range(20) for at in (2, 3)] + [(3, 0)]
        )


def test_windows_of_all_lengths_in_one_scan_equal_brute_force(spark, tmp_path):
    make = random.Random(4)
    texts = [" ".join(make.choices("abcd", k=make.randint(0, 40))) for _ in range(60)]
    wanted = [" ".join(make.choices("abcd", k=n % 13)) for n in range(30)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(f"i{n}", t) for n, t in enumerate(wanted)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in decontaminate.decontamination_query(spark, str(tmp_path)).collect()}
    for doc_id, words in enumerate(map(str.split, texts)):
        hit, items = set(), set()
        for n, item in enumerate(map(str.split, wanted)):
            k = min(10, len(item))
            own = {tuple(item[i : i + k]) for i in range(len(item) - k + 1)} if item else set()
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in own:
                    hit |= set(range(i, i + k))
                    items.add(f"i{n}")
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert got[doc_id] == (len(words), len(hit), len(items), digest)
    docs, windows = spark.read.parquet(f"{tmp_path}/documents.parquet"), decontaminate.benchmark_windows(spark.read.parquet(f"{tmp_path}/benchmark.parquet"))
    assert windows.select("length").distinct().count() == 10
    plan = decontaminate.scanned(docs, windows)._jdf.queryExecution().optimizedPlan().collectLeaves().toString()
    assert plan.count("doc_id") == 1


def test_a_document_of_many_hits_costs_in_proportion(spark):
    docs = spark.createDataFrame([(1, "a b c " * 50_000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b"), (2, "b c a b")], "item_id long, text string")
    begin = time.monotonic()
    row = decontaminate.contamination(docs, items).first()
    assert [(s.begin, s.end) for s in row.spans] == [(0, 149_999)] and row["items"] == ["1", "2"]
    assert time.monotonic() - begin < 60  # some seconds, where copying the spans per hit took hours


def test_line_dedup_edges(spark):
    rows = [(i, "h", f"common\nown {i}\n\n", 7, "x") for i in range(20)] + [(50, "h", None, None, "x"), (51, None, "common", 6, "x"), (52, "h", "", 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, n_chars long, lines string")
    out = line_dedup.drop_boilerplate(docs, counts=True)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    found = {r.doc_id: r for r in out.collect()}
    assert found[3].text == "own 3\n\n" and found[3].n_dropped == 1 and found[3].n_lines == 4 and found[3].n_chars == 7
    assert found[50].text is None and found[50].n_lines == 0 and found[51].text == "common" and found[52].text == ""
    assert line_dedup.drop_boilerplate(docs.limit(0)).count() == 0


def test_line_dedup_without_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"h{i % 2}", f"top {i % 2}\nown {i}") for i in range(40)], "doc_id long, source string, text string")
    normal = sorted(map(tuple, line_dedup.drop_boilerplate(docs).collect()))
    monkeypatch.setattr(line_dedup, "is_small", lambda df: False)
    assert sorted(map(tuple, line_dedup.drop_boilerplate(docs).collect())) == normal
    assert normal[0] == (0, "h0", "own 0")


def test_line_dedup_counts_lines_before_it_broadcasts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "h", "\n".join(f"line {n}" for n in range(9)) + f"\nown {i}") for i in range(20)], "doc_id long, source string, text string")
    asked = []
    monkeypatch.setattr(line_dedup, "is_small", lambda df: asked.append(df.count()))
    assert sorted(r.text for r in line_dedup.drop_boilerplate(docs).collect()) == sorted(f"own {i}" for i in range(20))
    assert asked == [9]


@pytest.mark.parametrize("small", [True, False])
def test_line_dedup_keeps_columns_of_any_name(spark, monkeypatch, small):
    monkeypatch.setattr(line_dedup, "is_small", lambda df: small)
    schema = "source string, text string, kept__ long, LINES__ long, salt__ long, host__ long, dropped__ long, n_lines long"
    docs = spark.createDataFrame([("h", f"top\nown {i}", 1, 2, 3, 4, 5, 6) for i in range(9)], schema)
    kept = line_dedup.drop_boilerplate(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [("h", f"own {i}", 1, 2, 3, 4, 5, 6) for i in range(9)]
    counted = line_dedup.drop_boilerplate(docs, counts=True)
    assert counted.columns == [*docs.columns[:-1], "n_lines", "n_dropped"]
    assert sorted(map(tuple, counted.collect()))[0] == ("h", "own 0", 1, 2, 3, 4, 5, 2, 1)


def test_line_dedup_drops_what_is_on_three_pages_in_a_hundred(spark):
    rows = [("h", ("rare\n" if i < 7 else "") + ("odd\n" if i < 4 else "") + f"own {i}") for i in range(200)]
    out = line_dedup.drop_boilerplate(spark.createDataFrame(rows, "source string, text string")).collect()
    assert sum("rare" in r.text for r in out) == 0 and sum("odd" in r.text for r in out) == 4


PAGES = "page_id long, url string, html string, payload string"


@pytest.mark.parametrize("slices", [2, 16])
def test_warc_round_trip_and_revisits(spark, slices):
    rows = [(5, "http://a/ b\r\nX: y", "same", ""), (2, None, "same", ""), (9, "http://c", "", ""), (3, "u", None, ""), (None, "n", "same", ""), (7, "é", "ünïque" * 9000, "")]
    folder = shared_folder(spark, "warc-test")
    pages = spark.createDataFrame(spark.sparkContext.parallelize(rows, slices), PAGES)
    warc.write_warc(pages, folder, date="2024-01-01T00:00:00Z")
    read = {r.page_id: r for r in warc.read_warc(spark, folder, payloads=True).collect()}
    sha = lambda text: base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
    assert {i: (r.record_type, r.refers_to) for i, r in read.items()} == {
        5: ("revisit", 2), 2: ("response", None), 9: ("revisit", 3), 3: ("response", None), None: ("revisit", 2), 7: ("response", None),
    }
    assert read[5].payload_bytes == 4 and read[5].payload_digest == sha("same") and read[5].payload is None
    assert bytes(read[7].payload).decode() == "ünïque" * 9000 and read[2].url == "urn:page:2"
    for path in glob.glob(f"{folder}/part-*"):
        assert os.path.getsize(path) > 0
        with gzip.open(path) as archive:
            assert (archive.read() or b"WARC/1.1\r\n").startswith(b"WARC/1.1\r\n")
    big = shared_folder(spark, "warc-test")
    warc.write_warc(spark.createDataFrame(rows, PAGES), big, revisit_min_bytes=1)
    assert warc.read_warc(spark, big).where("page_id in (3, 9) and record_type = 'response'").count() == 2


def test_warc_query_against_plain_python(spark, tmp_path):
    """Payloads repeat over many pages; the query's rows follow from the pages alone."""
    rows = [(i, f"http://h/{i}", None if i % 11 == 0 else f"<p>page {i % 7}</p>" * (i % 5), "") for i in range(300)]
    spark.createDataFrame(rows, PAGES).repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    payload = {i: (html or "").encode() for i, _, html, _ in rows}
    first = {}
    for i in sorted(payload):
        first.setdefault(payload[i], i)
    wanted = {
        (i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first[data] == i else "revisit", None if first[data] == i else first[data])
        for i, data in payload.items()
    }
    out = warc.warc_query(spark, str(tmp_path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert {tuple(r) for r in out.collect()} == wanted and out.count() == 300


def test_warc_damage_is_noticed_and_nothing_is_nothing(spark):
    data = warc.member(1, "u", b"payload", None, "2024-01-01T00:00:00Z")
    assert [warc.record_of(m)["page_id"] for m in warc.members_of(data + warc.EMPTY_MEMBER + data)] == [1, 1]
    record = next(warc.members_of(data))
    with pytest.raises(ValueError, match="digest"):
        warc.record_of(record.replace(b"payload\r\n", b"paYload\r\n"))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.members_of(data[:-9]))
    folder = shared_folder(spark, "warc-test")
    warc.write_warc(spark.createDataFrame([], PAGES), folder)
    assert warc.read_warc(spark, folder).count() == 0


def test_warc_by_salted_join(spark, monkeypatch):
    rows = [(i, "u", f"text {i % 3}", "") for i in range(30)]
    monkeypatch.setattr(warc, "is_small", lambda df: False)
    typed = warc.with_record_types(spark.createDataFrame(rows, PAGES)).collect()
    assert {(r.page_id, r.refers_to) for r in typed} == {(i, None if i < 3 else i % 3) for i in range(30)}


def test_top_k_edges(spark):
    rows = [(0, [1.0, 0.5]), (20, [0.5]), (1, [float("nan"), 1.0]), (2, None), (3, [None, 1.0]), (4, [-1.0, 0.0]), (5, []), (None, [9.0]), (5, []), (6, [1.0, 0.5])]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    out = [tuple(r) for r in topk.top_k(vectors, "vec_id % 20 = 0", k=3).orderBy("query_id", "rank").collect()]
    assert out == [(0, 1, 6, 5120), (0, 2, 20, 2048), (0, 3, 5, 0), (20, 1, 0, 2048), (20, 2, 6, 2048), (20, 3, 5, 0)]
    assert topk.top_k(vectors.limit(0), "vec_id % 20 = 0").count() == 0
    assert topk.top_k(vectors.where("vec_id = 0"), "vec_id % 20 = 0").count() == 0


def test_top_k_of_repeated_ids_equals_sql(spark):
    rows = [(i % 30, [float((i * m) % 11 - 5) for m in (1, 3, 7)]) for i in range(90)] + [(40, [9.0, 9.0])] * 25 + [(41, [9.0, 9.0])] * 2
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    connection = duckdb.connect()
    connection.execute("create table embeddings (vec_id bigint, embedding float[])")
    rows = [(i, [*e, 0.0][:3]) for i, e in rows]  # DuckDB multiplies lists of one length only
    connection.executemany("insert into embeddings values (?, ?)", rows)
    theirs = connection.execute(topk.ORACLE).fetchall()
    mine = topk.top_k(vectors, "vec_id % 20 = 0").select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, mine)) == sorted(theirs) and len(theirs) == 60


def test_top_k_in_blocks_finds_the_same(spark, monkeypatch):
    vectors = spark.range(400).select(F.col("id").alias("vec_id"), F.array(*[((F.col("id") * k) % 17 - 8).cast("float") / 8 for k in (1, 3, 7, 11, 13)]).alias("embedding"))
    whole = sorted(map(tuple, topk.top_k(vectors, "vec_id % 20 = 0").collect()))
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "RUN", 8)
    assert sorted(map(tuple, topk.top_k(vectors, "vec_id % 20 = 0").collect())) == whole
    assert len(whole) == 400


def test_loss_spans_are_places_in_the_formatted_text(spark):
    rows = [(1, i, ["system", "user", "assistant", "tool", "assistant"][i % 5], "é😀[" * (i % 4), "") for i in range(23)]
    rows += [(2, 0, "assistant", "x", ""), (2, 0, "assistant", "x", "")]
    for row in formatted(spark, rows).values():
        cut = [row.formatted[s.begin : s.begin + s.length] for s in row.loss_spans]
        assert cut == [s.text for s in row.segments if s.loss]
        assert "".join(s.text for s in row.segments) == row.formatted


def test_long_conversations_cost_in_proportion(spark):
    def seconds(turns):
        rows = spark.range(turns).selectExpr(
            "1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('text ', id) as text"
        )
        begun = time.monotonic()
        row = chat.read_chat(chat.format_chat(rows)).selectExpr("valid", "size(turns) t", "size(loss_spans) s", "size(learned) l").first()
        assert tuple(row) == (True, turns, turns // 2, turns // 2)
        return time.monotonic() - begun

    seconds(1_000)
    assert seconds(100_000) < 10 * max(seconds(25_000), 1)
