"""Runs, fill-in-the-middle and passages against brute force, on small tables with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    components,
    fill_in_middle,
    licences,
    mixing,
    near_duplicates,
    nearest,
    oracles,
    passages,
    periodic_runs,
    personal_data,
    quality,
    repetition,
    url_lists,
)

BLANK = r"[^\x20\x09-\x0d]+"
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def stretched(rng, unit, words):
    p = rng.choice([1, 1, 2, 3, 5, 16, 17, 33])
    some = [rng.choice(words) for _ in range(p)]
    return (some * 20)[: int(p * rng.choice([2, 3.5, 4, 4.2, 7, 12]))]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    made = []
    for k in (1, 2, 4, 40, 400):
        words = [f"w{i}" for i in range(k)]
        for _ in range(12):
            text = []
            for _ in range(rng.randrange(5)):
                text += [rng.choice(words) for _ in range(rng.randrange(30))] + stretched(rng, 1, words)
            made.append(" ".join(text))
    odd = [
        None, "", " \n\t ", "one", "a a a a a", "a a a a a a", "same  line\nsame line\tsame line same line",
        "x" * 5000, "İ ß é 漢字 🙂 " * 40, "ab " * 700, "a<P>b", "no <S> here <M>", "12 ab-CD\x00é", "<", "<P",
    ]
    rows = [(i, t) for i, t in enumerate(made + odd)]
    return rows + [(None, made[-1]), (None, None), (7, made[20]), (7, made[20]), (-3, "b " * 50)]


@pytest.fixture(scope="module")
def documents(spark, texts):
    rows = [(i, t, "clash", "clash", "clash", "clash", "clash") for i, t in texts]
    schema = "doc_id long, text string, row string, ID string, words string, n string, kind string"
    return spark.createDataFrame(rows, schema).repartition(3)


def runs_of(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        j = 0
        while j + q < n:
            if words[j] != words[j + q]:
                j += 1
                continue
            a = j
            while j + q < n and words[j] == words[j + q]:
                j += 1
            unit = words[a : a + q]
            smaller = any(q % d == 0 and unit == unit[:d] * (q // d) for d in range(1, q))
            if j - a + q >= max(6, 4 * q) and not smaller:
                found.append((a, q, j - a + q))
    return sorted(found)


def collapsed(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(a + q <= i < a + size for a, q, size in runs))


@pytest.mark.parametrize("tile", [32, periodic_runs.TILE])
def test_runs_match_brute_force_whatever_the_tiles(documents, texts, tile):
    found = periodic_runs.find_runs(documents, tile=tile)
    assert found.columns == ["id", "n", "runs", "collapsed"]
    got = Counter((r.id, r.n, tuple(map(tuple, r.runs)), r.collapsed) for r in found.collect())
    wanted = Counter()
    for i, text in texts:
        words = re.findall(BLANK, text or "")
        runs = runs_of(words)
        wanted[i, len(words), tuple(runs), collapsed(words, runs)] += 1
    assert got == wanted


def test_runs_of_nothing_and_as_digests(documents):
    assert periodic_runs.find_runs(documents.where("false")).count() == 0
    found = periodic_runs.find_runs(documents.where("text = 'ab '  or text like 'ab ab%'"), digest=True).first()
    assert (found.n, found.collapsed) == (700, hashlib.sha256(b"ab").hexdigest())


def test_words_that_only_hashes_would_mix_up_are_no_run(spark):
    even = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    odd = even.translate(str.maketrans("ab", "ba"))
    text = " ".join([even, odd] * 4)
    found = periodic_runs.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert [tuple(r) for r in found.first().runs] == [(0, 2, 8)]


def test_a_long_run_is_stitched_over_many_tiles(spark):
    words = [f"w{i}" for i in range(300)]
    text = " ".join(["x y z"] + [w for _ in range(20) for w in words] + ["end"])
    found = periodic_runs.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"), tile=32).first()
    assert [tuple(r) for r in found.runs] == [(3, 300, 6000)]
    assert found.collapsed == " ".join(["x y z", *words, "end"])


def test_cost_of_one_word_again_and_again_is_linear():
    words = np.zeros(200_000, np.int32)
    closed = np.array([False])
    found = periodic_runs.fragments(words, np.array([0, len(words)]), 2, 1 << 30, closed, closed)
    assert found == [(0, 1, 0, len(words) - 1)]


def filled(i, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(h[k] % (len(units) + 1) for k in range(2))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, len(units))))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return i, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return i, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_texts_are_turned_at_unit_boundaries(spark, documents, texts):
    rng = random.Random(12)
    more = [(1000 + i, "".join(rng.choice("abZz@[`{ é漢🙂<>PSM\n\x00\x7f9") for _ in range(rng.randrange(60)))) for i in range(400)]
    rows = texts + more
    every = documents.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    found = fill_in_middle.fill_in_middle(every)
    assert Counter(map(tuple, found.collect())) == Counter(filled(i, t) for i, t in rows)
    again = found.select("id", fill_in_middle.restored(F.col("output"), F.col("form")))
    assert Counter(map(tuple, again.collect())) == Counter((i, t or "") for i, t in rows)
    assert {r.form for r in found.collect()} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(documents.where("false")).count() == 0


def test_every_mark_is_selected_by_its_number():
    rng = np.random.default_rng(3)
    data = rng.choice(np.frombuffer("aZ é漢 .".encode(), np.uint8), 3000)
    marks = fill_in_middle.unit_ends(fill_in_middle.as_words(data), np.array([0, len(data)]))
    held = fill_in_middle.Marks(marks)
    places = np.flatnonzero(marks.view(np.uint8))
    assert np.array_equal(held.select(np.arange(1, len(places) + 1)), places)
    assert np.array_equal(held.rank(places), np.arange(len(places)))


def passages_of(documents, items, slop=passages.SLOP):
    windows = []
    for item, text in items:
        words = re.findall(TOKEN, lower(text or ""))
        size = min(10, len(words))
        windows += [(item, words[s : s + size]) for s in range(len(words) - size + 1)] if words else []
    for i, text in documents:
        words = re.findall(TOKEN, lower(text or ""))
        hit, exact, near = set(), set(), set()
        for item, window in windows:
            for s in range(-slop, len(words) + slop):
                if words[max(s, 0) : s + len(window)] == window and s >= 0:
                    hit |= set(range(s, s + len(window)))
                    exact.add(item)
                if all(w in words[max(s + j - slop, 0) : max(s + j + slop + 1, 0)] for j, w in enumerate(window)):
                    near.add(item)
        yield i, len(words), len(hit), tuple(sorted(str(x) for x in exact if x is not None)), tuple(
            sorted(str(x) for x in near if x is not None)
        )


@pytest.fixture(scope="module")
def contaminated():
    rng = random.Random(13)
    words = [f"t{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 9, 10, 11, 14, 30])))) for i in range(12)]
    items += [(2, "Again The Second"), (2, "Again The Second"), (100, None), (101, " .,; "), (None, "nobody knows"), (102, "é漢 ß")]
    rows = []
    for i in range(70):
        text = [rng.choice(words) for _ in range(rng.randrange(40))]
        if i % 2:
            passage = (rng.choice(items)[1] or "").split()
            if i % 3 == 0 and len(passage) > 3:
                passage.insert(rng.randrange(len(passage)), "extra")
            if i % 5 == 0 and len(passage) > 3:
                passage[1], passage[2] = passage[2], passage[1]
            text[5:5] = passage * (1 + i % 3)
        rows.append((i, " ".join(text).upper() if i % 4 == 0 else ", ".join(text)))
    rows += [(200, None), (201, ""), (202, "again the"), (203, "second"), (204, "nobody knows, again the second é漢 ß")]
    return rows + [(None, rows[5][1]), (7, rows[9][1]), (7, rows[9][1])], items


@pytest.mark.parametrize("limits", [{}, {"LIST": 2, "PIECE": 3, "SPREAD": 1}])
def test_passages_match_brute_force(spark, contaminated, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(passages, name, value)
    rows, items = contaminated
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, text string, block string, term string")
    bench = spark.createDataFrame([(*r, "clash") for r in items], "item_id long, text string, piece string")
    found = passages.decontaminate(docs.repartition(3), bench)
    got = Counter((r.id, r.n_words, r.n_hit, tuple(r.items), tuple(r.near_items)) for r in found.collect())
    assert got == Counter(passages_of(rows, items))
    assert any(near != exact for *_, exact, near in got)


def test_passages_without_items_or_documents(spark, contaminated):
    rows, items = contaminated
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    none = passages.decontaminate(docs, bench.where("false"))
    assert none.where("n_hit > 0 OR size(near_items) > 0").count() == 0
    assert none.count() == len(rows)
    assert passages.decontaminate(docs.where("false"), bench).count() == 0


def thue_morse():
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_made_to_collide_are_told_apart(spark):
    """Polynomial hashes modulo a power of two are equal for these two words."""
    one, two = thue_morse()
    lines = spark.createDataFrame([(1, f"{one}\n{two}"), (2, f"{one}\n{one}")], "doc_id long, text string")
    judged = repetition.judge_repetition(lines).orderBy("doc_id").collect()
    assert [r.n_dup_lines for r in judged] == [0, 1]
    windows = [f"x y {one} x y {two}", f"x y {one} x y {one}"]
    texts = spark.createDataFrame(list(enumerate(windows)), "doc_id long, text string")
    judged = repetition.judge_repetition(texts).orderBy("doc_id").collect()
    assert [r.n_repeat_words for r in judged] == [0, 6]
    pair = spark.createDataFrame([(1, one), (2, two), (3, two)], "doc_id long, text string")
    found = near_duplicates.near_duplicates(pair).orderBy("doc_id").collect()
    assert [r.component_id for r in found] == [1, 2, 2]


def test_a_long_text_takes_a_bounded_multiple_of_its_size():
    data = np.frombuffer(b"several words of some length and a line\n" * 250_000, np.uint8)
    tracemalloc.start()
    repetition.measures(data, np.array([0, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 * len(data)


def clashing(spark):
    """Documents beside columns that have the names the operators use themselves."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source")
    names = "kept_id kept_digest digest mix_id mix_source mix_size rows mean first row own_id own_size number block entry copy id size label role".split()
    return docs.select("*", *(F.lit("clash").alias(n) for n in names))


def test_rows_keep_their_columns_whatever_the_names(spark):
    docs = clashing(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.where("rows = 'clash' AND first = 'clash'").count() == mixing.mixed_documents(docs.select("doc_id", "text", "source")).count()
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    kept = quality.keep_quality(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == quality.keep_quality(docs.select("doc_id", "text", "source"), labels).count()


def test_slots_are_made_by_many_tasks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    _, slots = mixing.mix_plan(docs)
    per_task = slots.groupBy(F.spark_partition_id()).count()
    assert per_task.count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    again = mixing.mix_plan(docs.repartition(5))[1]
    assert slots.exceptAll(again).count() == 0


@pytest.mark.parametrize("together", [4, 1024])
def test_thousands_of_sources_meet_their_targets(spark, monkeypatch, together):
    """Draws in groups of sources add up to every source's quota."""
    monkeypatch.setattr(mixing, "SOURCES", together)
    many = 40 if together == 4 else 3000
    docs = spark.range(4 * many).selectExpr(
        "id AS doc_id", f"concat('s', id % {many}) AS source", "repeat('w ', int(60 + id * 7919 % 100)) AS text"
    )
    _, slots = mixing.mix_plan(docs, block=8, shards=16)
    got = {r.number: r.n for r in slots.groupBy("number").agg(F.count("*").alias("n")).collect()}
    found = mixing.mix_sources(docs, block=8, shards=16)
    off = found.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    assert off.where("abs(taken - target) > 0.03 * target + 8").count() == 0
    assert len(got) == many
    numbered = slots.groupBy("number", "slot").count()
    assert numbered.where("count > 1").count() == 0
    shards = [r.n for r in slots.groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert max(shards) - min(shards) <= 1


def shingles(text):
    words = re.findall(BLANK, lower(text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}


@pytest.mark.parametrize("similarity", [60, 80, 92])
def test_links_at_any_similarity_match_brute_force(spark, similarity):
    rng = random.Random(similarity)
    rows = []
    for group in range(14):
        base = [f"g{group}w{rng.randrange(300)}" for _ in range(90)]
        for _ in range(9):
            words = list(base)
            for _ in range(rng.randrange(12)):
                words[rng.randrange(90)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates.near_duplicates(frame, similarity=similarity).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: root(i) for i in range(len(rows))}
    assert len({r.component_id for r in found}) > 14


def test_a_similarity_that_signatures_cannot_find_is_refused(spark):
    for similarity in (0, 10, 101):
        with pytest.raises(ValueError, match="similarity"):
            near_duplicates.near_duplicates(spark.createDataFrame([(1, "a")], "doc_id long, text string"), similarity=similarity)
    counts = [near_duplicates.matches_for(s) for s in (100, 85, 80, 60)]
    assert counts == sorted(counts, reverse=True) and counts[0] == near_duplicates.COORDINATES


def test_components_of_hubs_and_chains(spark, monkeypatch):
    monkeypatch.setattr(components, "LINKS", 20)
    star = [(i, 500) for i in range(501, 900)] + [(i, 900) for i in range(100, 300)] + [(900, 899)]
    chain = [(i + 1, i) for i in range(2000, 2200)]
    pairs = [(3000 + 2 * i, 3001 + 2 * i) for i in range(50)]
    links = star + chain + pairs + [(7, 7), (3000, 3001)]
    found = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    wanted = {i: 100 for i in [*range(101, 300), *range(500, 901)]}
    wanted |= {i: 2000 for i in range(2001, 2201)} | {3001 + 2 * i: 3000 + 2 * i for i in range(50)}
    assert found == wanted


def captured(spark, urls, entries):
    captures = spark.createDataFrame([(i, u, "2024-02-01") for i, u in enumerate(urls)], "page_id long, url string, fetched_on string")
    listed = spark.createDataFrame([(p, "block", "2024-01-01") for p in entries], "pattern string, action string, listed_on string")
    found = url_lists.filter_captures(captures, listed).collect()
    return [r.pattern for r in sorted(found)]


def test_urls_of_any_length_are_looked_up(spark):
    deep = "http://long.org/" + "a/" * 60_000
    wide = "http://long.org/" + "x" * 1_000_000
    labels = "http://" + ".".join(["l"] * 5_000) + ".org/p"
    asked = "http://long.org/q?" + "k=v&" * 250_000
    entries = ["long.org/a/a/a", "long.org/x", "l.l.org", "long.org/q", "long.org/qq"]
    assert captured(spark, [deep, wide, labels, asked], entries) == ["long.org/a/a/a", None, "l.l.org", "long.org/q"]
    assert captured(spark, [deep, wide], ["org.uk"]) == [None, None]
    assert captured(spark, [wide], [wide]) == [wide.removeprefix("http://")]


def test_addresses_in_brackets_are_hosts(spark):
    urls = ["http://[2001:db8::1]/p", "http://[2001:aaaa::2]:8080/p/q", "http://u@[::1]", "http://[v1.a.b]/x"]
    entries = ["[2001:db8::1]", "https://[2001:AAAA::2]:443/p/", "a.b]", "[::1]"]
    assert captured(spark, urls, entries) == ["[2001:db8::1]", "[2001:aaaa::2]/p", "[::1]", None]


def test_a_cut_path_matches_whole_parts_only(spark):
    urls = ["http://h.org/abcdef", "http://h.org/abc/def", "http://h.org/abc", "http://h.org/ab/c", "http://h.org/abc?x=1"]
    assert captured(spark, urls, ["h.org/abc"]) == [None, "h.org/abc", "h.org/abc", None, "h.org/abc"]


def test_identifiers_in_other_spellings():
    automaton = personal_data.anchors()
    for text, expected in {
        "see HTTPS://bob:pw@host.org/x now": "see <URL> now",
        "Ftp+Tls://a@b.c": "<URL>",
        "password: hunterhunter": "password: <SECRET>",
        "api_key = 'abcdefghij' # own": "api_key = '<SECRET>' # own",
        "passwd=letmeinplease, then": "passwd=<SECRET>, then",
        "password: required for every user": "password: required for every user",
        "password is mandatory": "password is mandatory",
        "account no 12345 2024-05-06": "account no <ACCOUNT> 2024-05-06",
        "account: 1234 5678 2024-05-06, due": "account: <ACCOUNT> 2024-05-06, due",
        "account: 2024-05-067": "account: <ACCOUNT>",
        "account: 1234 5678 9012": "account: <ACCOUNT>",
    }.items():
        assert personal_data.redacted(text, personal_data.spans_of(text, automaton)) == expected


def test_sql_and_operator_agree_on_stretched_notices(spark, tmp_path):
    """Every notice with words put in, at the starts of a window and a half."""
    rng, rows = random.Random(21), [(0, None), (1, "")]
    for notice in licences.TEMPLATES:
        for inserted in (0, 5, 30, 50):
            for start in rng.sample(range(96), 12):
                words = notice.split()
                for _ in range(inserted):
                    words.insert(rng.randrange(1, len(words)), f"x{rng.randrange(10**6)}")
                rows.append((len(rows), " ".join([f"y{i}" for i in range(start)] + words + ["end"] * 5)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.coalesce(1).write.parquet(str(tmp_path / "documents"))
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
        wanted = connection.execute(oracles.LICENCE_SQL).fetchall()
    names = "doc_id n_words n_base first_word last_word base_labels labels score".split()
    found = licences.scan_licences(frame).select(*names).collect()
    assert Counter(map(tuple, found)) == Counter(wanted)
    assert sum(1 for r in found if r.labels) > len(rows) / 2


def test_repeated_queries_have_a_list_each(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(40)]
    rows += [(0, rows[0][1]), (0, rng.standard_normal(8).tolist()), (7, rows[3][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest.nearest(frame, frame.where("vec_id = 0"), k=10).collect()

    def wanted(query):
        return sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, query)))), i) for i, v in rows if i != 0)[:10]

    lists = [wanted(v) for i, v in rows if i == 0]
    assert Counter((r["rank"], r["id"]) for r in found) == Counter(
        (place, i) for near in lists for place, (_, i) in enumerate(near, start=1)
    )
    assert len(found) == 30


def brute_nearest(rows, queries, k):
    """Lists of (id, distance) for each query row, in doubles."""
    lists = []
    for own, query in queries:
        near = sorted((float(np.sqrt(((np.array(v) - query) ** 2).sum())), i) for i, v in rows if i != own)
        lists.append([(i, d) for d, i in near[:k]])
    return lists


@pytest.mark.parametrize("size", [3, 64, 300])
def test_estimates_bound_the_distances(size):
    rng = np.random.default_rng(size)
    vectors, queries = rng.standard_normal((400, size)), rng.standard_normal((50, size))
    queries[0] = vectors[0]
    turn = nearest.rotation(size, nearest.code_bits(size))
    assert np.allclose(turn.T @ turn, np.eye(size))
    away = vectors @ turn.T
    length = np.sqrt((away * away).sum(axis=1))
    fit = np.abs(away).sum(axis=1) / np.sqrt(away.shape[1]) / length
    codes = np.packbits(away > 0, axis=1).view(np.uint64)
    likely, low = nearest.Estimates(queries @ turn.T, nearest.WIDTH).bounds(codes, length, fit)
    true = ((queries[:, None] - vectors[None]) ** 2).sum(axis=2)
    assert (low <= true + 1e-9).all()
    scale = 2 * np.sqrt((queries**2).sum(axis=1))[:, None] * length
    assert np.abs((likely - true) / scale).max() < nearest.WIDTH * 1.1 / np.sqrt(nearest.code_bits(size) - 1)


def test_recall_against_every_distance(spark, tmp_path):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((20, 40))
    rows = [(i, (centres[i % 20] + 0.4 * rng.standard_normal(40)).tolist()) for i in range(6000)]
    rows += [(6000 + i, rows[7][1]) for i in range(1500)]  # one vector on a fifth of the rows
    path = str(tmp_path / "vectors")
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5).write.parquet(path)
    frame = spark.read.parquet(path)
    got = defaultdict(list)
    for r in nearest.nearest(frame, frame.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.id)
    queries = [(i, v) for i, v in rows if i % 50 == 0]
    wanted = {q: [i for i, _ in near] for (q, _), near in zip(queries, brute_nearest(rows, queries, 10))}
    assert set(got) == set(wanted)
    same = sum(len(set(got[q]) & set(wanted[q])) for q in wanted)
    assert same >= 0.99 * 10 * len(wanted)
    assert got[7000] == wanted[7000]  # ties by the smaller id


@pytest.mark.parametrize("factor", [1e160, 1e300, 1e-200])
def test_nearest_of_very_large_and_very_small_vectors(spark, factor):
    rng = np.random.default_rng(3)
    plain = [(i, rng.standard_normal(6).tolist()) for i in range(60)]
    rows = [(i, [x * factor for x in v]) for i, v in plain]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest.nearest(frame, frame.where("vec_id = 10"), k=5).orderBy("rank").collect()
    (near,) = brute_nearest(plain, [plain[10]], 5)
    assert [r.id for r in found] == [i for i, _ in near]
    assert [r.score / factor for r in found] == pytest.approx([d for _, d in near])


def test_queries_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(nearest, "QUERY_BYTES", 4 * 8 * 8)
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(90)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest.nearest(frame, frame.where("vec_id % 3 = 0"), k=3).orderBy("query_id", "rank").collect()
    queries = [(i, v) for i, v in rows if i % 3 == 0]
    assert [r.id for r in found] == [i for near in brute_nearest(rows, queries, 3) for i, _ in near]


def test_quality_against_plain_models(spark):
    """Counts, ratios, levels and the draw of 300 texts, from dictionaries."""
    rng = random.Random(12)
    good, bad = "the river runs along a quiet field".split(), "ugly vile awful".split()
    rows = []
    for i in range(300):
        words = [rng.choice(good) for _ in range(rng.randrange(5, 40))]
        if i % 3 == 1:
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        if i % 3 == 2:
            words = ["".join(rng.choices("xqzé#", k=6)) for _ in words]
        rows.append((i, " ".join(words)))
    rows += [(300, None), (301, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = [(i, int(i % 3 == 0), int(i % 3 == 1)) for i, _ in rows[:240]]
    labels = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    fits = {
        r.doc_id: r.turn % 2 == 0
        for r in labels.select("doc_id", F.xxhash64(F.lit(quality.SEED), "doc_id").alias("turn")).collect()
    }
    noise = {
        r.doc_id: -np.log(-np.log(((r.h & (1 << 64) - 1) >> 11) / 2**53 + 0.5 / 2**53))
        for r in docs.select(
            "doc_id", F.xxhash64(F.lit(quality.SEED), "doc_id", F.xxhash64("text")).alias("h")
        ).collect()
    }

    def grams(text):
        data = text.encode()
        whole = (int.from_bytes(data[i : i + 4]) for i in range(len(data) - 3))
        return Counter((g * 0x9E3779B1 % 2**32) >> 16 for g in whole)

    def words(text):
        return set(re.findall(rb"[0-9a-z\x80-\xff]+", lower(text).encode()))

    texts = {i: t for i, t in rows if t}
    raw, target, wanted, unwanted = Counter(), Counter(), Counter(), Counter()
    for i, text in texts.items():
        raw += grams(text)
        if fits.get(i) and i % 3 == 0:
            target += grams(text)
            wanted += Counter(words(text))
        if fits.get(i) and i % 3 == 1:
            unwanted += Counter(words(text))
    scale, size = target.total() / raw.total(), quality.FORM_BUCKETS

    def form(text):
        return sum(
            n * np.log((target[g] + scale) / (target.total() + scale * size) / ((raw[g] + 1) / (raw.total() + size)))
            for g, n in grams(text).items()
        )

    def content(text):
        even = unwanted.total() / wanted.total()
        return min(0.0, *(np.log((wanted[w] * even + 1) / (unwanted[w] + 1)) for w in words(text)))

    forms, contents = ({i: f(t) for i, t in texts.items()} for f in (form, content))
    held_out = [i for i, q, _ in known if q and not fits[i]]
    levels = [np.percentile([f[i] for i in held_out], 100 * quality.BELOW) for f in (forms, contents)]
    for by_words in (False, True):
        for draw in (None, 0, 40, 10_000):
            found = {r.doc_id: r for r in quality.weigh_quality(docs, labels, draw=draw, by_words=by_words).collect()}
            weights = {i: forms[i] - levels[0] for i in texts}
            if by_words:
                weights = {i: min(w, (contents[i] - levels[1]) * quality.CONTENT_SCALE) for i, w in weights.items()}
            assert {i: r.log_weight for i, r in found.items() if r.log_weight is not None} == pytest.approx(
                weights, rel=1e-4, abs=1e-3
            )
            k = sum(found[i].log_weight >= 0 for i in texts) if draw is None else min(draw, len(texts))
            place = {i: np.floor((found[i].log_weight + noise[i]) * 1e6) for i in texts}
            last = sorted(place.values(), reverse=True)[k - 1] if k else np.inf
            assert {i for i, r in found.items() if r.kept} == {i for i, p in place.items() if p >= last}
            assert not found[300].kept and not found[301].kept
