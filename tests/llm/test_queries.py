"""The registered queries over whole small tables: against their DuckDB statements where
there are any, else against plain single-process versions; and the pipeline, stage by stage."""

from __future__ import annotations

import pytest

import corpus_pipeline
from keelson.llm.oracle import SQL
from keelson.llm.queries import QUERIES, RULES
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text, lang FROM documents").fetchall()


@pytest.mark.parametrize("name", sorted(SQL))
def test_statement(spark, con, name):
    ok, message = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name], digits=None)
    assert ok, message


def rows(spark, name):
    return QUERIES[name](spark, SF_SMALL).collect()


def test_op1(spark, con):
    plain = [(r.verdict, r.text) for r in RULES]
    got = {r.page_id: r for r in rows(spark, "op1_url_filter")}
    pages = con.execute("SELECT page_id, url FROM pages").fetchall()
    assert len(got) == len(pages)
    for i, url in pages:
        host, path, rule, verdict = brute.url_rule(url, plain)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
    scores, limit = brute.url_scores([u for _, u in pages], plain)
    judged = 0
    for i, url in pages:
        verdict = brute.url_rule(url, plain)[3]
        if verdict or not url or limit is None:
            assert got[i].verdict == (verdict or "allow")
            continue
        assert got[i].score == pytest.approx(scores[url])
        judged += 1
        if abs(scores[url] - limit) > 1e-9:
            assert got[i].verdict == ("block" if scores[url] < limit else "allow")
    assert limit is not None and judged > 5


def test_op3(spark, con, docs):
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    want = {i: (n, hit, len(names), brute.sha(",".join(names)), hit > 0)
            for i, n, hit, names in brute.decontaminate([d[:2] for d in docs], items)}
    got = {r.doc_id: tuple(r)[1:6] for r in rows(spark, "op3_decontaminate")}
    assert got == want and any(w[-1] for w in want.values())


def test_op4(spark, docs):
    want = {i: (n, c, c == i) for i, n, c in brute.near_dedup([d[:2] for d in docs], 2)}
    assert {r.doc_id: tuple(r)[1:] for r in rows(spark, "op4_near_dedup")} == want


def test_op6(spark, docs):
    want = {i: (n, gone, brute.sha(kept))
            for i, n, gone, kept in brute.substring_dedup([d[:2] for d in docs])}
    assert {r.doc_id: tuple(r)[1:] for r in rows(spark, "op6_substring_dedup")} == want


def test_op9(spark, con):
    first: dict = {}
    want = {}
    for i, html in con.execute("SELECT page_id, html FROM pages ORDER BY page_id").fetchall():
        size, digest = len((html or "").encode()), brute.sha(html or "")
        old = first.setdefault(digest, i)
        again = size >= 100 and old != i
        want[i] = (size, digest, "revisit" if again else "response", old if again else None)
    assert {r.page_id: tuple(r)[1:5] for r in rows(spark, "op9_warc")} == want


def test_op10_on_held_out_documents(spark, docs):
    from zlib import crc32
    langs = {i: lang for i, _, lang in docs}
    got = rows(spark, "op10_language_id")
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    right = sum(r.lang_pred == langs[r.doc_id] for r in held)
    assert right >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in got)


def test_op10_equals_plain_expectation_maximisation(spark, docs):
    from zlib import crc32
    learned = [(lang, text) for i, text, lang in docs if crc32(str(i).encode()) % 4 != 2]
    some = [d for d in docs if len(d[1] or "") < 4000][:90]
    want = brute.language_mixture(learned, [text for _, text, _ in some])
    got = {r.doc_id: r for r in rows(spark, "op10_language_id")}
    for (i, _, _), (lang, score, chosen) in zip(some, want):
        assert (got[i].lang_pred, got[i].languages) == (lang, ",".join(chosen))
        assert got[i].score == pytest.approx(score, abs=2e-3)


def test_more_labels_than_are_learned(spark, monkeypatch):
    """The labels with the most rows are learned; the others do no harm."""
    from keelson.llm import language_id as lang
    monkeypatch.setattr(lang, "MOST_LANGUAGES", 3)
    rows = [(k, "ka ta ma pa la " * 9, "aa") for k in range(9)] + [
        (100 + k, "strich blond kern dorf " * 9, "bb") for k in range(8)] + [
        (200 + k, "ooou eeau aii yeu " * 9, "cc") for k in range(2)] + [
        (300 + k, "zzz xxx qqq " * 9, f"typo{k:03}") for k in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang.train(df)
    assert model[0] == ["aa", "bb", "cc"]
    got = {r.doc_id: r.lang_pred for r in lang.predict(df, model, ["doc_id"]).collect()}
    assert got[0] == "aa" and got[100] == "bb" and got[200] == "cc" and got[300] in model[0]


CODE = ("for (int i = 0; i < n; ++i) { buf[i] = xs[idx[i]] ^ mask; if (!ptr->next) goto err; }\n"
        "static inline void kfree_rcu(struct rq *q) { atomic_dec(&q->cnt); WARN_ON(q->flags); }\n")
FINNISH = ("kuitenkin hän ei ollut vielä päättänyt mitä tekisi seuraavaksi sillä yöllä oli satanut "
           "lunta ja pihamaalla näkyi jäniksen jälkiä jotka johtivat metsän reunaan saakka ")
WELSH = ("mae hi'n bwrw glaw yng nghymru heddiw ond fe fydd yr haul yn tywynnu yfory medd rhagolygon "
         "y tywydd felly peidiwch ag anghofio eich hetiau wrth fynd allan i'r mynyddoedd ")


def test_language_stage_rejects_what_is_no_known_language(spark):
    """Code, noise and unseen languages in Latin letters go; clean documents and mixtures stay."""
    import random

    from pyspark.sql import functions as F

    from tests.conftest import SF_CHECK
    r = random.Random(2)
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    noise = " ".join("".join(r.choice("qwrtpsdfghjklzxcvbnm") for _ in range(r.randrange(4, 9)))
                     for _ in range(80))
    strange = [(-1, CODE * 20), (-2, noise), (-3, FINNISH * 4), (-4, WELSH * 4),
               (-5, "\u0436\u0449\u044b " * 40), (-6, "12 34"), (-7, None)]
    by = {x["lang"]: x["t"] for x in docs.filter("length(text) > 3000").groupBy("lang").agg(
        F.first("text").alias("t")).collect()}
    langs = sorted(k for k in by if k)
    mixed = [(-100 - k, " ".join(by[c][:1500].rsplit(" ", 1)[0] for c in langs[k:k + 3]))
             for k in range(len(langs) - 1)]
    more = spark.createDataFrame(strange + mixed, "doc_id long, text string").select(
        *[F.col(c) if c in ("doc_id", "text") else F.lit(None).cast(t).alias(c)
          for c, t in docs.dtypes])
    kept = {x.doc_id for x in corpus_pipeline.language_stage(spark, docs.unionByName(more), "").collect()}
    assert not kept & {i for i, _ in strange}
    assert {i for i, _ in mixed} <= kept
    clean = [x.doc_id for x in docs.collect() if any(c.isalpha() for c in x.text or "")]
    assert sum(i in kept for i in clean) >= 0.99 * len(clean)


def test_language_stage_keeps_recognised_mixtures(spark):
    """A text in three languages of equal parts stays; one in none of them goes."""
    import random
    r = random.Random(8)
    sound = {"aa": "ka ta ma pa la", "bb": "strich blond kern dorf", "cc": "ooou eeau aii yeu"}
    say = lambda k, n: " ".join("".join(r.choices(sound[k].split(), k=2)) for _ in range(n))
    rows = [(k, say(c, 60), c) for k, c in enumerate(["aa", "bb", "cc"] * 20)]
    rows += [(2000 + k, " ".join(say(c, n) for c, n in (("aa", 140), ("bb", 60), ("cc", 90))), None)
             for k in range(8)]
    rows += [(3000, "\u0436\u0449\u044b " * 40, None), (3001, "123", None), (3002, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.language_stage(spark, docs, "").collect()
    assert {x.doc_id for x in kept} == {i for i, *_ in rows} - {3000, 3001, 3002}


def test_language_stage_learns_and_calibrates_on_all_labelled_rows(spark):
    """Also where a language stands in one fold only; no row is left out of the limits."""
    from zlib import crc32

    from keelson.llm import language_id as lang
    inside = [k for k in range(4000) if crc32(str(k).encode()) % 4 == 2]
    outside = [k for k in range(4000) if crc32(str(k).encode()) % 4 != 2]
    texts = {"aa": "ka ta ma pa la " * 12, "bb": "strich blond kern dorf " * 8}
    rows = [(k, texts["aa"], "aa") for k in inside[:40]] + [
        (k, texts["bb"], "bb") for k in outside[:45]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, others = lang.train_folds(docs)
    assert model[0] == ["aa", "bb"] and others[2][0] == ["bb"]
    whole = lang.train(docs)
    assert whole[0] == model[0] and (whole[1] == model[1]).all()
    limits = lang.calibrate(docs, model, others)
    at = len(lang.trigrams(texts["bb"]))
    assert lang.LENGTHS[0] <= at < lang.LENGTHS[1] and limits["bb", 1] > 1
    own = [lang.identify(lang.trigrams(texts["bb"]), m)[2] for n, m in others if "bb" in n]
    assert min(own) - 3 <= limits["bb", 1] <= max(own)
    kept = {x.doc_id for x in corpus_pipeline.language_stage(spark, docs, "").collect()}
    assert kept == {i for i, *_ in rows}


def test_near_stage_with_missing_and_repeated_ids(spark):
    """One of a group stays, also where an unrelated row without an id, or with the id of
    the one that stays, is kept."""
    words = [f"w{k}" for k in range(300)]
    a, b, c, d = (" ".join(words[k:k + 70]) for k in (0, 70, 140, 210))
    rows = [(None, d), (1, a), (None, a + " z"), (2, b), (2, b + " z"), (2, b), (2, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(x) for x in corpus_pipeline.near_stage(spark, docs, "").collect()]
    assert len(kept) == 4 and {(None, d), (1, a), (2, c)} < set(kept)


def test_pipeline(spark):
    """Every stage on what the one before kept, against the plain versions."""
    from keelson.llm.common import store, table
    kept = table(spark, SF_SMALL, "documents")
    columns, seen = kept.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in kept.collect()}
        kept = store(stage(spark, kept, SF_SMALL), name)
        if name != "mixing":
            assert kept.columns == columns
        after = {r.doc_id: r for r in kept.collect()}
        seen[name] = (before, after)
    before, after = seen["language_id"]
    assert all(t is None or not any(c.isalpha() for c in t)
               for i, t in before.items() if i not in after)
    before, after = seen["line_dedup"]
    for i, text, _, gone in brute.line_dedup(list(before.items()), long_words=50):
        if gone and not brute.words(text):
            assert i not in after
        else:
            assert after[i].text == text and after[i].n_chars == len(text)
    before, after = seen["near_dedup"]
    assert {i for i, _, c in brute.near_dedup(list(before.items()), 5) if i == c} == set(after)
    before, after = seen["decontamination"]
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    assert {i for i, _, hit, _ in brute.decontaminate(list(before.items()), items)
            if not hit} == set(after)
    before, after = seen["mixing"]
    assert set(after) <= set(before) and all(r.taken > 0 for r in after.values())
    total = sum(len(brute.words(t)) for t in before.values())
    assert abs(sum(r.taken for r in after.values()) - total) <= 20
