"""Ranked lexical search, token counts and conversation repair against plain versions."""

import hashlib
import itertools
import math
import re
import zlib

import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from pagefolio.llm import conversation_repair as cr
from pagefolio.llm import lexical_search, queries, token_counts

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- op11 ------------------------------------------------------------------------------------------


def plain_search(docs, items, limit=10):
    terms = [TERM.findall((t or "").translate(FOLD)) for _, t in docs]
    held = [i for i, t in enumerate(terms) if t]
    big_n, big_l = len(held), sum(len(terms[i]) for i in held)
    df = {}
    for i in held:
        for t in set(terms[i]):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        q = TERM.findall((text or "").translate(FOLD))
        scored = []
        for i in held:
            n, score = len(terms[i]), 0
            m = 25 + (75 * n * big_n) // big_l
            for t in q:
                tf = terms[i].count(t)
                if tf:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((score, docs[i][0]))
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, r + 1, d, s) for r, (s, d) in enumerate(scored[:limit])]
    return sorted(out, key=str)


DOCS = [
    (1, "The cat sat on the mat."), (2, "the CAT, the cat!"), (3, None), (4, ""), (5, "Dogs and cats; über Katzen"),
    (6, "the cat sat on the mat."), (6, "the cat sat on the mat."), (None, "cat cat cat"), (7, "x" * 5000 + " cat"),
    (8, "Ünïcode wörds 123 abc123 cat"),
]
ITEMS = [(0, "the cat"), (1, "über Katzen dogs"), (2, None), (None, "mat mat cat"), (3, "nothing matches here")]


def test_search_plain(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("_row", F.lit(9))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((tuple(r) for r in lexical_search.ranked(docs, items).collect()), key=str)
    assert got == plain_search(DOCS, ITEMS)


def test_search_limit_and_ties(spark):
    docs = [(i, "a b") for i in range(30, 0, -1)] + [(100, "a a b")]
    got = lexical_search.ranked(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame([(0, "a")], "item_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_search(docs, [(0, "a")])
    assert [r.rank for r in sorted(got, key=lambda r: r.rank)] == list(range(1, 11))


def test_search_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.ranked(empty, items).count() == 0
    assert lexical_search.ranked(spark.createDataFrame(DOCS, "doc_id long, text string"), empty.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_search_query(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    items = pd.read_parquet(f"{SF}/benchmark.parquet")
    got = sorted((tuple(r) for r in queries.op11_lexical_search(spark, SF).collect()), key=str)
    want = plain_search(list(zip(docs.doc_id.tolist(), docs.text.tolist())), list(zip(items.item_id.tolist(), items.text.tolist())))
    assert got == want


# -- op12 ------------------------------------------------------------------------------------------


def test_token_counts(spark, tmp_path):
    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = [(1, "Hello <s> world </s>"), (2, None), (3, ""), (3, ""), (4, "ü" * 30000), (None, "x y"), (5, "Hello <s> world </s>")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("digest", F.lit("x"))
    cache = str(tmp_path / "cache")
    for _ in range(2):
        got = sorted((tuple(r) for r in token_counts.token_counts(docs, model, cache, limit=10).collect()), key=str)
        want = sorted(((i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 10) for i, t in texts), key=str)
        assert got == want
        # Distinct texts are encoded once; the second run adds nothing.
        assert spark.read.parquet(cache).count() == 4
    assert token_counts.token_counts(docs.filter("false"), model, cache).count() == 0


# -- op13 ------------------------------------------------------------------------------------------


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out


def enumerate_repairs(rows, fault):
    """Every way of keeping, rerolling, deleting and inserting (at most two rows per gap)."""
    gaps = ["", "u", "a", "ua", "au"]
    best = None
    options = [["D"] if f in ("blank", "duplicate") else ["K", "Ru", "Ra", "D"] for f in fault]
    for choice in itertools.product(*options):
        for inserts in itertools.product(gaps, repeat=len(rows) + 1):
            roles, audit, cost = [], "", 0
            for i in range(len(rows) + 1):
                roles += list(inserts[i])
                audit += "I" * len(inserts[i])
                cost += 3 * len(inserts[i])
                if i == len(rows):
                    break
                c = choice[i]
                audit += c[0]
                if c == "D":
                    cost += 4
                    continue
                roles.append(rows[i][0][:1] if c == "K" else c[1])
                cost += (3 if c != "K" else 0) + (3 if fault[i] == "truncated" else 0)
            if re.fullmatch("(s?(ua)+)?", "".join(roles)):
                best = min(best, (cost, audit)) if best else (cost, audit)
    return best


@pytest.mark.parametrize("roles", ["ua", "au", "s", "sua", "uua", "xa", "aas"])
def test_repair_against_enumeration(roles):
    texts = ["Hi.", "Hi", "  "]
    for pick in itertools.product(range(len(texts)), repeat=len(roles)):
        rows = [(r if r != "x" else "tool", texts[p]) for r, p in zip(roles, pick)]
        frame = pd.DataFrame({"turn": range(len(rows)), "role": [r for r, _ in rows], "text": [t for _, t in rows]})
        fault = cr.faults(frame)
        got = cr.cheapest(cr.symbols(frame, fault), cr.rule_matrices([]))
        assert got == enumerate_repairs(rows, fault), rows


def test_grammar_changes_nothing():
    rules = [("Ā", "A", "B"), ("ā", "Ā", "Ā"), ("Ă", "C", "E")]
    matrices, plain = cr.rule_matrices(rules), cr.rule_matrices([])
    for string in ["", "AB", "ABABAB", "CEABFCE", "IIHGFEDCBA" * 3]:
        assert cr.cheapest(cr.compress(string, rules), matrices) == cr.cheapest(string, plain)


def plain_repair(table):
    damaged = plain_damage(table)
    out = {}
    for conv in {r[0] for r in table}:
        rows = [r for r in damaged if r[0] == conv]
        frame = cr._ordered(pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"turn": "float"}))
        fault = cr.faults(frame) if rows else []
        turns = frame["turn"].dropna()
        initials = [r[:1] for r in frame["role"]]
        cost, audit = cr.cheapest(cr.symbols(frame, fault), cr.rule_matrices([])) if rows else (0, "")
        out[conv] = (
            int(turns.max() - turns.min() + 1 - turns.nunique()) if len(turns) else 0,
            fault.count("blank"), fault.count("duplicate"), fault.count("truncated"),
            sum(1 for x, y in zip(initials, initials[1:]) if x + y not in ("su", "ua", "au")), cost, audit,
            hashlib.sha256("\n".join(cr.repaired(frame, audit)).encode()).hexdigest(),
        )
    return out


def test_repair_query(spark):
    table = pd.read_parquet(f"{SF}/conversations.parquet")
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in table[["conv_id", "turn", "role", "text"]].itertuples(index=False)]
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (900, None, "assistant", "Ok"), (900, 3, "user", "x."),
             (900, 3, "user", "x."), (915, 2, "user", "Hello there.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
        "audit", F.lit("clash"))
    got = {r.conv_id: tuple(r)[1:9] for r in cr.repaired_conversations(frame, max_rules=40).collect()}
    want = plain_repair(rows)
    assert got == want
    # 915 drops its only row (crc32 of "915:2" is 0 mod 20).
    assert zlib.crc32(b"915:2") % 20 == 0 and got[915] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert cr.repaired_conversations(frame.filter("false")).count() == 0
