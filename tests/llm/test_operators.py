"""Each operator on hard rows: NULLs, empty and very long texts, ties, repeated rows, empty
tables and extra columns with clashing names, against plain single-process versions."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from keelson.llm import chat_format as chat
from keelson.llm import language_id as lang
from keelson.llm import warc
from keelson.llm.common import lookup
from keelson.llm.components import components
from keelson.llm.decontamination import decontaminate
from keelson.llm.exact_dedup import DigestIndex, digests, exact_dedup
from keelson.llm.line_dedup import line_dedup
from keelson.llm.mixing import mix
from keelson.llm.near_dedup import near_dedup
from keelson.llm.substring_dedup import substring_dedup
from keelson.llm.url_filter import Rule, judge_urls
from tests.llm import brute

#: Names that the operators use inside; they must not mind them in their input.
CLASHING = ("id", "t", "n", "key", "size", "copy", "kept", "node", "runs", "digest", "w",
            "segment", "hash", "score", "text_", "n_lines", "n_removed", "row", "words")


def rng_text(seed, n, vocabulary=60):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def hard_rows():
    base = rng_text(1, 120, 5000)
    words = base.split()
    shared = rng_text(2, 60, 5000)
    near = lambda k: " ".join(x if i % 41 != k else f"x{k}" for i, x in enumerate(words))
    lines = "\n".join(rng_text(50 + k, 6) for k in range(8))
    rows = [(1, base), (2, base), (3, base.upper()), (4, near(1)), (5, near(2)), (6, near(3)),
            (7, None), (8, ""), (9, " \n\t "), (10, "one"), (11, "ONE"), (12, "one two"),
            (13, shared + " " + rng_text(3, 40, 5000)), (14, rng_text(4, 30, 5000) + " " + shared),
            (15, lines), (16, "intro\n" + lines + "\noutro"), (17, "a\n\nb\n\n\nc\na\n \nb\nc"),
            (18, "loop the loop " * 30), (19, rng_text(5, 30_000, 8000)),
            (20, "a b 　c d é̂ \U0001F600"), (21, "x\ny\nx\ny\nx\ny\nx\ny"),
            (1, base), (None, base), (None, None), (22, shared), (22, shared)]
    return rows + [(100 + k, f"filler {k} " + rng_text(100 + k, 25, 5000)) for k in range(40)]


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(i, t, "abc"[k % 3] if k % 7 else None, "en" if k % 2 else None)
            for k, (i, t) in enumerate(hard_rows())]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHING]).repartition(4).cache()


def same(got, expected):
    assert Counter(map(repr, got)) == Counter(map(repr, expected))


def test_substring_dedup(hard):
    got = substring_dedup(hard).collect()
    same([(r.id, r.n_words, r.n_removed, r.text or "") for r in got],
         brute.substring_dedup(hard_rows()))
    assert [r.text for r in got if r.id == 7] == [None]


def test_line_dedup(hard):
    got = line_dedup(hard)
    assert set(hard.columns) <= set(got.columns)
    same([(r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()],
         brute.line_dedup(hard_rows()))


def test_line_dedup_of_long_single_lines(spark):
    """A line of over 50 words goes where it also stands earlier, beside the runs of three."""
    passage, rows = rng_text(70, 52, 5000), hard_rows()
    rows += [(200, "one\n" + passage + "\ntwo"), (201, rng_text(71, 30) + "\n\n" + passage),
             (202, passage), (203, "short\n" + rng_text(72, 50, 5000)),
             (204, rng_text(72, 50, 5000)), (205, f"{passage}\nx\n{passage}")]
    rows += [(None, rng_text(73, 60)), (206, "a\n" + rng_text(73, 60))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = line_dedup(df, long_words=50).collect()
    same([(r.doc_id, r.text, r.n_lines, r.n_removed) for r in got],
         brute.line_dedup(rows, long_words=50))
    text = {r.doc_id: r.text for r in got}
    assert (text[200], text[201], text[202]) == (rows[-8][1], rng_text(71, 30) + "\n", "")
    assert (text[204], text[205], text[206]) == (rng_text(72, 50, 5000), "x", "a")


@pytest.mark.parametrize("seed", range(6))
def test_line_dedup_of_crossing_runs(spark, seed):
    """Few distinct lines: runs overlap, cross, repeat within a document and part from the first
    of their fingerprint on either side."""
    r = random.Random(seed)
    rows = [(k // 2 if seed == 5 else k, "\n".join(
        r.choice("abcdefgh"[:r.choice([2, 4, 8])]) if r.random() < .9 else " "
        for _ in range(r.randrange(0, 25)))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same([(x.doc_id, x.text, x.n_lines, x.n_removed) for x in line_dedup(df).collect()],
         brute.line_dedup(rows))


def test_line_dedup_is_native(spark):
    df = spark.createDataFrame([(1, "a\nb\nc")], "doc_id long, text string")
    plan = line_dedup(df, long_words=50)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "InArrow", "InPandas"))


@pytest.mark.parametrize("size", [2, 5])
def test_near_dedup(hard, size):
    got = [(r.id, r.size, r.component_id) for r in near_dedup(hard, shingle=size).collect()]
    same(got, brute.near_dedup(hard_rows(), size))


def test_near_dedup_chain_and_false_centre(spark):
    """A chain of texts of which neighbours only are similar, and texts that share buckets
    with a centre they are not similar to: components as from all pairs."""
    words = rng_text(9, 300, 9000).split()
    rows = [(k, " ".join(words[k * 12:k * 12 + 150])) for k in range(12)]
    rows += [(50 + k, " ".join(words[:100] + [f"y{k}{j}" for j in range(18 + k)]))
             for k in range(12)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.id, r.size, r.component_id) for r in near_dedup(df, shingle=2).collect()]
    same(got, brute.near_dedup(rows, 2))


def test_near_dedup_keeps_one_document_of_repeated_and_missing_ids(spark):
    base, far = rng_text(81, 200, 5000), rng_text(82, 200, 5000)
    rows = [(None, rng_text(83, 90, 5000)), (None, base + " z"), (1, base), (2, far),
            (2, far + " z"), (2, rng_text(84, 90, 5000)), (None, "a " + rng_text(85, 90, 5000)),
            (None, "b " + rng_text(85, 90, 5000)), (None, ""), (3, None), (3, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for shingle in (2, 5):
        got = near_dedup(df, shingle=shingle)
        kept = got.join(df.select(F.xxhash64("text").alias("t"), "text"), "t").filter("kept")
        texts = Counter(r.text for r in kept.collect())
        assert [texts[x] for x in (rows[0][1], base, base + " z", rows[5][1], "", None, " ")] == [
            1, 1, 0, 1, 1, 1, 1]
        assert texts[far] + texts[far + " z"] == 1
        assert texts[rows[6][1]] + texts[rows[7][1]] == 1


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 99), (99, 98), (98, 100), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in components(df).collect()}
    assert got == {**{k: 0 for k in range(41)}, 98: 98, 99: 98, 100: 98}


def test_decontamination(spark, hard):
    rows = hard_rows()
    long = rows[0][1]
    items = [(1, " ".join(long.split()[20:40])), (2, "One two"), (3, None), (4, "  "), (5, "ONE"),
             (6, rng_text(5, 30_000, 8000)[3000:3400]), (6, "filler 3"), (None, "loop; the-loop"),
             (7, "nothing such here " * 5), (1, " ".join(long.split()[20:40]))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("t", F.lit(1))
    got = decontaminate(hard, bench).collect()
    same([(r.id, r.n_words, r.n_hit, r["items"]) for r in got], brute.decontaminate(rows, items))


def test_proximity_and_slices(spark, monkeypatch):
    import keelson.llm.decontamination as d
    monkeypatch.setattr(d, "ITEM_WORDS", 3)
    monkeypatch.setattr(d, "SEGMENT_WORDS", 8)
    docs = spark.createDataFrame(
        [(1, "alpha x beta y gamma"), (2, "alpha z"), (3, "beta gamma"), (4, "alpha beta gamma"),
         (5, "q alpha beta gamma alpha beta")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "alpha beta gamma"), (2, "gamma alpha"), (3, "beta q")],
                                  "item_id long, text string")
    got = {r.id: r for r in d.decontaminate(docs, bench, slop=2).collect()}
    assert {k: (v.n_hit, v["items"]) for k, v in got.items()} == {
        1: (0, []), 2: (0, []), 3: (0, []), 4: (3, ["1"]), 5: (4, ["1", "2"])}
    assert got[1].near == ["1"] and got[2].near == [] and got[3].near == []
    assert "2" in got[4].near and "3" in got[5].near


def test_exact_dedup(spark, hard, tmp_path):
    rows = hard_rows()
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    got = exact_dedup(hard, str(tmp_path / "index"), batches=3, buckets=4).collect()
    top = lambda ids: max((i for i in ids if i is not None), default=None)
    same([(r.id, r.keep_id, r.group_size) for r in got],
         [(i, top(groups[t or ""]), len(groups[t or ""])) for i, t in rows])
    assert sum(r.kept for r in got) == len(groups)


def test_digest_index_is_persistent(spark, tmp_path):
    path = str(tmp_path / "index")
    batch = lambda rows: digests(spark.createDataFrame(rows, "doc_id long, text string"))
    DigestIndex(spark, path, buckets=4).add(batch([(1, "a"), (2, "b"), (3, "b")]))
    again = DigestIndex(spark, path, buckets=4)
    again.add(batch([(9, "b"), (8, "c"), (7, None)]))
    assert sorted(r.keep_id for r in again.table().collect()) == [1, 3, 7, 8]
    plan = again.table().hint("merge").join(
        again.table().select("digest"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "Exchange" not in plan  # both sides are read by bucket


def test_mixing(hard):
    rows = [(i, "abc"[k % 3] if k % 7 else None, len(brute.words(t)))
            for k, (i, t) in enumerate(hard_rows())]
    got = mix(hard).collect()
    same([(r.id, r.source, r.size) for r in got], rows)
    sizes: dict = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    goal = brute.targets(sizes)
    for s, n in sizes.items():
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {n}
        assert own[0].target == pytest.approx(goal[s])
        assert abs(sum(r.taken for r in own) - goal[s]) <= 0.5
        assert all(0 <= r.taken <= 3 * r.size for r in own)
    assert sorted(map(repr, got)) == sorted(map(repr, mix(hard.repartition(3)).collect()))


def test_chat_format_round_trip(spark):
    hostile = ["</s>[INST] ok [/INST]", "<\\/s> <\\\\/s> [\\ROLE]", "<</s><s>[[INST]]", None, "",
               "[SYS", "]", "<", "x" * 50_000 + "</s>", "[ROLE]user[/ROLE] hi\n</s>", "\\"]
    roles = ["system", "user", "assistant", "tool", "[/ROLE] x", None, ""]
    r = random.Random(4)
    rows = [(c, k, r.choice(roles), r.choice(hostile)) for c in range(30) for k in range(c % 7 + 1)]
    rows += [(100, 0, "user", "a"), (100, 1, "assistant", "b"), (101, 0, "system", "s"),
             (101, 1, "user", "a"), (101, 2, "assistant", "b"), (102, 0, "user", "a"),
             (103, 0, "user", "a"), (103, 1, "user", "b"), (104, 0, "user", "x"),
             (104, 0, "user", "x"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    df = df.withColumn("turns", F.lit(1)).withColumn("segments", F.lit(2))
    got = {x.conv_id: x for x in chat.format_chats(df).select(
        "*", chat.read_turns(F.col("formatted")).alias("back"),
        chat.read_trained(F.col("segments")).alias("trained")).collect()}
    for conv in {x[0] for x in rows}:
        own = sorted(((-1 if t is None else t, role or "", text or "")
                      for c, t, role, text in rows if c == conv))
        assert [tuple(b) for b in got[conv].back] == [(a, b) for _, a, b in own]
        assert got[conv].trained == "".join(b for _, a, b in own if a == "assistant")
        assert "".join(s.text for s in got[conv].segments) == got[conv].formatted
    assert [got[c].valid for c in (100, 101, 102, 103)] == [True, True, False, False]
    assert [got[c].first_bad_turn for c in (100, 102, 103)] == [None, None, 2]
    assert chat.format_chats(df.limit(0)).count() == 0


RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"),
         Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))


def test_url_filter(spark):
    urls = [f"https://a{k}.example.net/en/{k}" for k in range(30)]
    urls += [f"http://shop{k}.buy.net/deal?x={k}" for k in range(30)]
    urls += ["https://a99.example.com/en/99", "http://shop77.buy.com/deal?x=77", None, "", "://",
             "no scheme", "HTTPS://A.Example.NET/en/x", "http://net", "http://xnet/", "http://net/",
             "http://b.ORG/fr/ü?q=/de/", "http://b.org/frx", "http://example.com/de/://x.net/",
             "http://example.net/en", "http://example.net:80/en/", "http://long.com/" + "a" * 50_000]
    rows = [(k, u) for k, u in enumerate(urls)] + [(0, urls[0]), (0, urls[0]), (None, urls[1])]
    df = spark.createDataFrame(rows, "page_id long, url string").select(
        "*", *[F.lit(1).alias(c) for c in ("id", "n", "host", "gram", "score")])
    got = judge_urls(df, RULES).collect()
    plain = [(r.verdict, r.text) for r in RULES]
    same([(r.id, r.host, r.path, r.rule) for r in got],
         [(i, *brute.url_rule(u, plain)[:3]) for i, u in rows])
    for r in got:
        decided = [brute.url_rule(u, plain)[3] for i, u in rows if i == r.id]
        assert decided[0] is None or r.verdict == decided[0]
    verdict = {r.id: r.verdict for r in got}
    assert verdict[60] == "allow" and verdict[61] == "block" and verdict[62] == "allow"
    assert judge_urls(df.limit(0), RULES).count() == 0
    assert {r.verdict for r in judge_urls(df.filter("page_id = 62"), RULES).collect()} == {"allow"}
    scores, limit = brute.url_scores(urls, plain)
    for r in got:
        url = dict(rows).get(r.id)
        if r.rule is None and url:
            assert r.score == pytest.approx(scores[url])
            assert r.verdict == ("block" if scores[url] < limit else "allow")


def test_url_model_is_witten_bell(spark):
    """The folded log-probabilities against the formula, computed from plain counts."""
    from math import log

    from keelson.llm import url_filter as u
    train = [("allow", "http://ab/"), ("allow", "http://abab"), ("block", "http://ba")]
    df = spark.createDataFrame(train, "verdict string, url string")
    used = df.select(F.explode(u.grams(F.col("url"), 2)).alias("gram")).groupBy("gram").agg(
        F.count(F.lit(1)).alias("uses"))
    got = {r.gram: r for r in u._model(used, df, 2).collect()}

    def p(label, gram):
        value = 1 / u.SYMBOLS
        texts = ["\x02\x02" + t.split("//")[1] + "\x03" for v, t in train if v == label]
        for k in range(3):
            context, symbol = gram[2 - k:2], gram[2]
            follow = Counter(t[i] for t in texts for i in range(2, len(t)) if t[i - k:i] == context)
            n, kinds = sum(follow.values()), len(follow)
            if n:
                value = (follow[symbol] + kinds * value) / (n + kinds)
        return log(value)

    assert len(got) > 5
    for gram, r in got.items():
        assert r.la == pytest.approx(p("allow", gram)) and r.lr == pytest.approx(p("block", gram))


def test_warc_round_trip(spark, tmp_path):
    big = "</html>\r\n\r\nWARC/1.0\r\n" + "é" * 70_000
    pages = [(1, "http://b.com/x", big), (5, "http://a.com/\ny", big), (2, None, None), (3, "", ""),
             (4, "https://A.com:8080/q?z", "short"), (6, "x", "short"), (7, "http://a.com/", big),
             (None, "http://n.com/", "p" * 100), (8, "http://a.com/", "p" * 100),
             (9, "http://a.com/", "p" * 100), (4, "https://A.com:8080/q?z", "short"),
             (10, "http://a.com/", "é" * 50), (11, "http://a.com/", "é" * 50)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn(
        "digest", F.lit("x")).repartition(3)
    path = str(tmp_path / "w")
    warc.write_archives(warc.plan_records(df), path)
    got = warc.capture_history(spark, path).collect()
    revisits = {5: 1, 7: 1, 9: 8, 11: 10}
    same([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got],
         [(i, len((h or "").encode()), brute.sha(h or ""),
           "revisit" if i in revisits else "response", revisits.get(i)) for i, _, h in pages])
    assert all(r.intact for r in got)
    keys = [(r.url_key, r.time, r.page_id or 0) for r in sorted(got, key=lambda r: r.place)]
    assert keys == sorted(keys) and keys[-1][0].startswith("x")
    empty = str(tmp_path / "e")
    warc.write_archives(warc.plan_records(df.limit(0)), empty)
    assert warc.capture_history(spark, empty).count() == 0


def test_warc_history_over_many_ranges(spark, tmp_path):
    """Ids of 64 bits, years of five digits, a URL and a page that are captured very often."""
    ids = [2 ** 62, -2 ** 63, 2 ** 63 - 1, 300_000_000_000, -5, None, 0]
    pages = [(ids[k % 7] if k % 3 else k, f"http://h{k % 5 if k % 2 else 0}.org/", "x" * (k % 9),
              f"{2024 + (k % 4) * (9000 if k % 11 == 0 else 0)}-0{1 + k % 9}-03 04:05:0{k % 10}")
             for k in range(600)] + [(77, "http://h0.org/", "y", "2024-01-01 00:00:00")] * 200
    df = spark.createDataFrame(pages, "page_id long, url string, html string, d string")
    dated = df.withColumn("d", F.expr("make_timestamp_ntz(int(split(d, '-')[0]), 1, 3, 4, 5, 6)"))
    for name, column in (("plain", None), ("dated", "d")):
        path = str(tmp_path / name)
        warc.write_archives(warc.plan_records(dated.repartition(6), date_col=column), path)
        got = warc.capture_history(spark, path, per_range=120).collect()
        assert len(got) == len(pages) and len({r.range for r in got}) == 7
        sizes = Counter(r.range for r in got)
        assert max(sizes.values()) < 3 * len(pages) / 7
        ordered = sorted(got, key=lambda r: (r.range, r.place))
        keys = [(r.url_key, r.time, r.page_id is not None, r.page_id or 0) for r in ordered]
        assert keys == sorted(keys)
        assert Counter(r.page_id for r in got) == Counter(x[0] for x in pages)
        if column:
            assert any(r.captured.startswith("+") for r in got)
            assert {str(r.time // 10 ** 10) for r in got} == {x[3].split("-")[0] for x in pages}


def test_warc_archives_are_bounded_by_bytes(spark, tmp_path):
    r = random.Random(4)
    noise = lambda n: "".join(chr(33 + r.randrange(90)) for _ in range(n))
    pages = [(k, f"http://a.org/{k}", noise(1_000_000 if k % 5 == 0 else 2_000)) for k in range(100)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    path = tmp_path / "w"
    warc.write_archives(warc.plan_records(df), str(path), archive_bytes=3_000_000)
    files = list(path.glob("*.gz"))
    assert len(files) >= 8 and max(f.stat().st_size for f in files) < 3_000_000
    assert len(files) < 45
    got = warc.capture_history(spark, str(path)).collect()
    assert len(got) == 100 and all(x.intact for x in got)


def test_time_number():
    dates = ["-0044-03-15T00:00:00Z", "1999-12-31T23:59:59Z", "2024-01-01T00:00:00Z",
             "2024-01-01T00:00:01Z", "9999-12-31T23:59:59Z", "+11530-08-16T00:00:00Z"]
    assert [warc.time_number(d) for d in dates] == sorted(warc.time_number(d) for d in dates)


def test_loser_tree():
    r = random.Random(5)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((str(r.randrange(30)), "", r.randrange(9)) for _ in range(r.randrange(20)))
                for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for run in runs for x in run)


def test_language_id(spark):
    r = random.Random(6)
    sound = {"aa": "ka ta ma pa la", "bb": "strich blond kern dorf", "cc": "ooou eeau aii yeu"}
    say = lambda k, n: " ".join("".join(r.choices(sound[k].split(), k=2)) for _ in range(n))
    rows = [(k, say(c, 60), c) for k, c in enumerate(["aa", "bb", "cc"] * 20)]
    rows += [(100, None, "aa"), (101, "", "bb"), (102, "123 !?", None), (103, say("aa", 20_000), None),
             (104, say("aa", 100) + " " + say("bb", 20), None), (None, say("cc", 9), None),
             (0, rows[0][1], "aa"), (105, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn(
        "lang_pred", F.lit("zz")).withColumn("counts", F.lit(1))
    model = lang.train(df.filter(~lang.held_out()))
    got = lang.predict(df, model, ["doc_id"]).collect()
    assert len(got) == len(rows)
    by = {x.doc_id: x for x in got}
    assert all(by[k].lang_pred == c for k, _, c in rows[:60])
    assert [(by[k].lang_pred, by[k].score) for k in (100, 101, 102)] == [("und", 0.0)] * 3
    assert by[103].languages == ["aa"] and by[104].languages == ["aa", "bb"]
    letters = [len(lang.trigrams(x)) for x in (say("aa", 100), say("bb", 20))]
    assert by[104].score == pytest.approx(letters[0] / sum(letters), abs=0.05)
    assert by[None].lang_pred == "cc"
    nothing = lang.train(df.limit(0))
    assert {x.lang_pred for x in lang.predict(df, nothing, []).collect()} == {"und"}


def test_language_id_letters_above_the_first_plane(spark):
    """Emoji and symbols are blanks, letters of the higher planes are letters."""
    emoji, gothic = "\U0001F600 \U0001F44D\U0001D7D8", "\U00010330\U00010331\U00010332"
    assert len(lang.trigrams(emoji)) == 0 and len(lang.trigrams(gothic)) == 3
    assert lang.trigrams("ka" + emoji + "ta").tolist() == lang.trigrams("ka ta").tolist()
    rows = [(1, "ka ta ma pa la", "aa"), (2, "strich blond", "bb"), (3, emoji, None),
            (4, "ka ta " + emoji, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang.train(df)
    by = {x.doc_id: x for x in lang.predict(df, model, ["doc_id"]).collect()}
    assert (by[3].lang_pred, by[3].score, by[3].languages) == ("und", 0.0, [])
    assert by[4].lang_pred == "aa"


@pytest.mark.parametrize("run", [
    lambda s, d, p: substring_dedup(d), lambda s, d, p: line_dedup(d),
    lambda s, d, p: near_dedup(d), lambda s, d, p: mix(d),
    lambda s, d, p: exact_dedup(d, p + "/i", buckets=2),
    lambda s, d, p: decontaminate(d, d.withColumnRenamed("doc_id", "item_id"))],
    ids=["substring", "line", "near", "mix", "exact", "decontaminate"])
def test_empty_and_null_tables(spark, tmp_path, run):
    df = spark.createDataFrame([(None, None, None)] * 2, "doc_id long, text string, source string")
    assert run(spark, df.limit(0), str(tmp_path / "a")).count() == 0
    assert run(spark, df, str(tmp_path / "b")).count() == 2


def test_lookup_leaves_no_large_partition(spark, tmp_path):
    """A key with a third of the rows, and NULL keys with a fifth, go to all tasks evenly."""
    n, parts = 120_000, 8
    k = F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 5 == 1, F.lit(None)).otherwise(
        F.col("id") % 5000)
    spark.range(n).select(k.cast("long").alias("k"), F.col("id").alias("v")).write.parquet(
        str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    right = left.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    before = {c: spark.conf.get(c) for c in (
        "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, v in zip(before, ("false", "-1")):
            spark.conf.set(c, v)
        joined = lookup(left, right, "k", "n", F.col("v"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        rows = joined.withColumn("part", F.spark_partition_id()).collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(k#" in x]
    assert sum("_salt#" in x for x in dealt) == 2, plan
    count = Counter(r.k for r in rows)
    assert all(r.n == (count[r.k] if r.k is not None else None) for r in rows)
    sizes = Counter(r.part for r in rows)
    assert sum(sizes.values()) == n and len(sizes) == parts
    assert max(sizes.values()) < 2 * n / parts


def related_groups(small, large):
    """Two groups of near copies whose texts are alike, but not similar: they share buckets."""
    r = random.Random(31)
    words = [f"w{r.randrange(9000)}" for _ in range(120)]
    other = [x if k % 9 else f"o{k}" for k, x in enumerate(words)]
    rows = []
    for k, base in enumerate((words, other)):
        for n in range((small, large)[k]):
            at = r.randrange(len(base))
            rows.append((k * 100_000 + n, " ".join(base[:at] + [f"z{k}n{n}"] + base[at:])))
    return rows


def test_edit_join_does_not_pair_a_group_with_itself(spark, monkeypatch):
    from keelson.llm import near_dedup as near
    seen, across = [], near._across_labels

    def counting(places):
        p, q = across(places)
        meet = [F.col("p.way") == F.col("q.way"), F.col("p.side") == F.col("q.side")]
        pairs = p.join(q, meet).select("p.m", "p.place", "q.m", "q.place", "p.label", "q.label")
        found = Counter(map(tuple, pairs.collect()))
        probing, posted = places.filter("place <= probe"), places.filter("place <= post")
        apart = probing.alias("p").join(posted.alias("q"), (F.col("p.key") == F.col("q.key")) & (
            F.col("p.label") != F.col("q.label")))
        assert found == Counter(map(tuple, apart.select(
            "p.m", "p.place", "q.m", "q.place", "p.label", "q.label").collect()))
        seen.append((places.count(), sum(found.values())))
        return p, q

    monkeypatch.setattr(near, "_across_labels", counting)
    rows = related_groups(150, 300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same([(r.id, r.size, r.component_id) for r in near.near_dedup(df, shingle=2).collect()],
         brute.near_dedup(rows, 2))
    assert seen and all(0 < pairs < places for places, pairs in seen)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_ids_of_any_type_come_back(spark, kind):
    """The smallest number, NULL and text ids return unchanged."""
    shared = rng_text(61, 40, 5000)
    ids = [-2 ** 63, None, 5, 2 ** 63 - 1] if kind == "long" else ["b", None, "a", "é"]
    rows = list(zip(ids, [shared + " x", rng_text(62, 30), "y " + shared, shared])) + [
        (ids[0], None), (None, "")]
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string")
    cut = {(r.id, r.text): r.n_removed for r in substring_dedup(df).collect()}
    assert Counter(i for i, _ in cut) == Counter(i for i, _ in rows)
    first = min((i for i in ids if i is not None))
    assert cut[(first, dict(rows[:4])[first])] == 0
    assert sum(n for n in cut.values()) == 2 * len(shared.split())
    bench = spark.createDataFrame([(1, shared)], "item_id long, text string")
    hit = Counter((r.id, r.n_hit) for r in decontaminate(df, bench).collect())
    assert hit == Counter((i, 40 if shared in (t or "") else 0) for i, t in rows)


def test_one_index_for_all_slices(spark, monkeypatch):
    from keelson.llm import decontamination as deco
    items = [(k, rng_text(500 + k, 25, 3000)) for k in range(60)]
    rows = [(k, rng_text(700 + k, 50, 3000) + " " + " ".join(items[k][1].split()[3:20]))
            for k in range(0, 60, 3)] + [(99, rng_text(9, 80))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    size = sum(len(t) for _, t in items)
    monkeypatch.setattr(deco, "ITEM_WORDS", size // (6 * 5) + 1)
    built, plain = [], deco.store
    monkeypatch.setattr(deco, "store", lambda df, name: built.append(name) or plain(df, name))
    assert len(deco._items(bench, "item_id", "text")) == 5
    got = deco.decontaminate(docs, bench, slop=None).collect()
    assert built == ["phrase_index"]
    same([(r.id, r.n_words, r.n_hit, r["items"]) for r in got], brute.decontaminate(rows, items))


def test_sketch_in_two_levels(spark):
    from keelson.llm import substring_dedup as sub
    texts = spark.createDataFrame([(rng_text(k % 7, 60, 900),) for k in range(40)], "text string")
    plain = sub.merged_sketch(texts.repartition(9), 20, 8, 18)
    split = sub.merged_sketch(texts.repartition(9), 20, 8, 18, spread=4)
    assert all((a == b).all() and a.any() for a, b in zip(plain, split))


def test_edits_meet_only_where_a_component_probes(spark):
    """Components without a probe share a number, edits without a probe go; no pair is lost."""
    from keelson.llm import near_dedup as near
    # (m, key, place, probe, post, label): edit 1 has two probing components of three members,
    # and 40 silent ones; edit 2 silent ones only; in edit 3 every component probes
    rows = [(k, 1, 1, 0, 1, 100 + k) for k in range(40)]
    rows += [(50 + k, 1, 1, 1, 1, 1000) for k in range(2)] + [(60, 1, 1, 1, 1, 2000)]
    rows += [(k, 2, 1, 0, 1, 100 + k) for k in range(40)]
    rows += [(70 + k, 3, 1, 1, 1, 3000 + k) for k in range(5)]
    places = spark.createDataFrame(rows, "m long, key long, place int, probe int, post int, label long")
    p, q = near._across_labels(places)
    met = p.join(q, [F.col("p.way") == F.col("q.way"), F.col("p.side") == F.col("q.side")]).select(
        F.col("p.m"), F.col("q.m")).collect()
    want = [(a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and a[5] != b[5] and a[3]]
    assert sorted(map(tuple, met)) == sorted(want)
    assert q.filter("m < 40").count() <= 2 * 40  # not once for each bit of 42 numbers


def test_edits_without_a_partner_within_reach_are_not_listed(spark):
    """Many components share an edit so late that too few edits are left of nearly all of them."""
    from keelson.llm import near_dedup as near
    # (m, key, of, place, probe, post, size, linked, label): edit 1 stands early in two members of
    # two components and late in 60; edit 2 early in two members of one component, late in others;
    # edit 3 has two components only
    rows = [(k, 1, 60, 50, 50, 50, 100, False, k) for k in range(60)]
    rows += [(100, 1, 60, 1, 50, 50, 100, False, 100), (101, 1, 60, 3, 50, 50, 104, False, 101)]
    rows += [(102 + k, 2, 60, 1, 50, 50, 100, False, 100) for k in range(2)]
    rows += [(104 + k, 2, 60, 50, 50, 50, 100, False, 101 + k) for k in range(2)]
    rows += [(106 + k, 3, 60, 50, 50, 50, 100, False, 100 + k) for k in range(2)]
    places = spark.createDataFrame(rows, "m long, key long, of int, place int, probe int, "
                                   "post int, size long, linked boolean, label long")

    def enough(a, b):
        left = min(a[2] - a[3], b[2] - b[3]) + 1
        return 2 * 180 * left >= 180 * (a[2] + b[2]) - 20 * (a[6] + b[6])

    paired = {a[0] for a in rows for b in rows if a[1] == b[1] and a[8] != b[8] and enough(a, b)}
    kept = near._partnered(places, 80)
    assert kept.columns == places.columns
    assert {r.m for r in kept.collect()} == paired | {106, 107} == {100, 101, 106, 107}
    p, q = near._across_labels(kept)
    assert p.count() + q.count() <= 8  # 62 components of edit 1 took 6 places each


def test_url_symbols_carry_no_url(spark, monkeypatch):
    """What is stored and shuffled for each symbol of a URL has a bounded width."""
    from keelson.llm import url_filter as u
    widths, plain = {}, u.lookup

    def watched(left, right, key, weight, spread):
        if left.columns[0] == "row":
            widths["symbol"] = dict(left.dtypes)
            widths["model"] = len(right.columns)
        return plain(left, right, key, weight, spread)

    monkeypatch.setattr(u, "lookup", watched)
    urls = ["https://a.org/fr/x", "https://b.net/y", "https://c.com/z", None, "https://c.com/z"]
    df = spark.createDataFrame([(k % 4, v) for k, v in enumerate(urls)], "page_id long, url string")
    got = u.judge_urls(df, RULES).collect()
    assert Counter(r.id for r in got) == Counter(k % 4 for k in range(5))
    assert widths == {"symbol": {"row": "bigint", "half": "int", "gram": "string"}, "model": 5}
