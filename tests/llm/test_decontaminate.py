import re
import hashlib

from pyspark.sql import functions as F

from mesonlab.llm import decontaminate as D
from tests.llm.helpers import EDGE, SF, SF2, duck, frame, same, saved

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def brute(docs, bench):
    words = lambda t: W.findall((t or "").translate(LOW))
    wins = {}
    for i, t in bench:
        w = words(t)
        n = min(len(w), 10)
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, items = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if got := wins.get(tuple(w[k:k + n])):
                    items |= got
                    hit |= set(range(k, k + n))
        out.append((repr(i), len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


BENCH = [(10, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (9, "Short item"), (8, ""), (7, None), (11, "ÉTÉ ß 漢字"), (12, "mu nu " * 9),
         (13, "one two three four five six. one two three four")]
DOCS = [*EDGE, (20, "x ALPHA beta, gamma delta epsilon zeta eta theta iota kappa lambda mu nu"), (21, "alpha beta gamma delta epsilon zeta eta theta iota"), (22, "a short ITEM b short item"),
        (23, "short"), (24, "ÉTÉ ß 漢字!"), (25, "mu nu " * 40), (26, "Short"), (27, "item")]


def rows(df):
    return sorted((repr(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def test_matches_brute_force(spark, tmp_path):
    sf = saved(spark, tmp_path, documents=frame(spark, DOCS), benchmark=frame(spark, BENCH, "item_id long, text string"))
    assert rows(D.op2_decontamination(spark, sf)) == brute(DOCS, BENCH)


def test_matches_sql(spark):
    for sf in (SF, SF2):
        same(D.op2_decontamination(spark, sf).toPandas(), duck(D.ORACLE_OP2, sf))


def test_many_blocks_give_the_same(spark):
    docs, bench = frame(spark, DOCS), frame(spark, BENCH, "item_id long, text string")
    one = D.scan_documents(docs, bench).toPandas()
    many = D.scan_documents(docs, bench, block_windows=4).toPandas()
    same(one.map(str), many.map(str))


def test_removal_and_clashing_columns(spark):
    docs = frame(spark, DOCS).withColumn("items", F.lit(1)).withColumn("w", F.lit(2)).withColumn("row", F.lit(3))
    bench = frame(spark, BENCH, "item_id long, text string")
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} & {20, 22, 24, 25, 4} == set()
    cut = {r.doc_id: r.text for r in D.decontaminate(docs, bench, "spans").collect()}
    assert cut[20] == "x  nu" and cut[22] == "a  b " and cut[21] == dict(DOCS)[21] and cut[1] is None


def test_empty_tables(spark):
    docs, bench = frame(spark, DOCS), frame(spark, BENCH, "item_id long, text string")
    assert D.scan_documents(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert D.scan_documents(docs.limit(0), bench).count() == 0
