"""Operators on documents against plain versions, with the rows that are easily got wrong."""

import base64
import collections
import hashlib
import itertools
import json
import math
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagefolio.llm import (
    byte_bpe,
    language_id,
    near_duplicates,
    ngram_trie,
    packing,
    personal_data,
    quality_rules,
)
from pagefolio.llm.elias_fano import Sequence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Columns that clash with names used inside the operators.
CLASH = "row long, key long, node long, label long, bands long, lang_pred string, score double, held_out int"


def lower(text):
    return "".join(c.lower() if c < "\x80" else c for c in text)


def corpus(seed=0, n=60):
    """Texts with copies, near copies, odd characters and edge cases, and their ids."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeé ", k=rng.randint(2, 6))).replace(" ", "") or "x" for _ in range(300)]
    texts = []
    for _ in range(n):
        text = rng.choices(vocabulary, k=rng.randint(30, 90))
        texts.append(" ".join(text))
        if rng.random() < 0.5:  # a chain of near copies
            for _ in range(rng.randint(1, 6)):
                text = list(text)
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
                texts.append(" ".join(text))
    texts += [texts[0], texts[0], None, "", " \n\t", "one", "One", "two words", "İstanbul ſ ß ΟΔΟΣ", "x" * 5000,
              "long " * 20_000, "\x00\x85\u2028 odd", "don't I'LL 12345 日本語 😀👍🏽"]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    rows += [rows[3], (None, rows[5][1]), (None, None)]  # a repeated row, rows without an id
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(3)
    for column in CLASH.split(", "):
        name, kind = column.split()
        df = df.withColumn(name, F.lit(1).cast(kind))
    return df.cache()


def empty(docs):
    return docs.filter("false")


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# -- quality -----------------------------------------------------------------------------------
def plain_quality(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = collections.Counter(windows)
    covered = {i + j for i, v in enumerate(windows) if often[v] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality(spark, docs):
    extra = ["a b c d e f g h " * 3 + "i", "a b\n" * 30, "w " * 7, " ".join("abcdefgh") * 2, "# " * 40, "STOP NOW " * 3 + "THIS IS A TEXT OF TWENTY WORDS OR MORE BUT ALL OF THEM SHOUT AT YOU"]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(extra, 900)), "doc_id long, text string"))
    report = quality_rules.quality_report(more).collect()
    want = collections.Counter((i, *plain_quality(t)) for i, t in pairs(more))
    assert collections.Counter(tuple(r)[:7] for r in report) == want
    assert not any(r.kept for r in report if r.base_failed)
    assert {r.doc_id: r.kept for r in report}[905] is False
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns
    count = collections.Counter(r.doc_id for r in quality_rules.quality_report(docs, order=list(quality_rules.RULES)).collect() if r.kept)
    assert collections.Counter(r.doc_id for r in kept.collect()) == count
    assert quality_rules.quality_report(empty(docs)).count() == quality_rules.kept_documents(empty(docs)).count() == 0


def test_cascade_order():
    stats = [
        {"rule": "a", "seconds": 1.0, "rejected": 10}, {"rule": "b", "seconds": 0.1, "rejected": 5},
        {"rule": "c", "seconds": 2.0, "rejected": 0},
    ]
    assert quality_rules.cascade_order(stats, "abcd") == ["b", "a", "c", "d"]


# -- language ------------------------------------------------------------------------------------
def test_language(spark, docs):
    rng = random.Random(3)
    syllables = {"en": ["the", "ing", "er"], "de": ["sch", "ung", "ein"], "fr": ["eau", "tion", "é"], "es": ["ción", "los", "ñ"]}
    rows = [
        (i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(30)), lang)
        for i, lang in enumerate(rng.choices(list(syllables), k=400))
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(table)
    assert model.families == ["germanic", "romance"] and set(model.pair_weights) == {("de", "en"), ("es", "fr")}
    got = {r.doc_id: r for r in language_id.predictions(table, model).collect()}
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].lang_pred == rows[i][2] for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    odd = language_id.predictions(docs, model)
    assert odd.columns.count("lang_pred") == 1 and odd.count() == docs.count()
    for row, text in zip(odd.collect(), [t for _, t in pairs(docs)], strict=True):
        assert (row.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
    assert language_id.documents_in(docs, model).columns == docs.columns
    none = language_id.train(empty(docs))
    assert {r.lang_pred for r in language_id.predictions(table, none).collect()} == {"und"}


def test_sample_bound_shared_by_languages(spark):
    """A hundred lang values share one row bound; rows stay float32."""
    rows = [(i, f"{'abcdefghij'[i % 10]}{'klmnopqrst'[(i // 10) % 10]} word {i}", f"l{i % 100}") for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = language_id.sample_features(table, total=400)
    assert len(samples) == 100 and all(x.dtype == np.float32 and len(x) <= 4 for x in samples.values())
    assert sum(len(x) for x in samples.values()) <= 400


def test_documents_in_learned_languages(spark):
    """Unlearned languages and gibberish go, clean documents stay, and all stay where no row is labelled."""
    rng = random.Random(6)
    words = {
        "en": "the and of to in is that for it with as was on are this which have from they water house people under".split(),
        "de": "der und die das ist nicht ein mit auf für sich den von werden haben wasser haus leute unter schule durch".split(),
        "fr": "le et la les des est une dans pour que qui sur avec pas plus sont eau maison gens sous école par nous".split(),
        "es": "el y la los que es una en para por con no más son agua casa gente bajo escuela como pero está muy".split(),
    }
    rows = [(i, " ".join(rng.choices(words[lang], k=rng.randint(25, 80))), lang) for i, lang in enumerate(rng.choices(list(words), k=800))]
    odd = [
        "tämä on pitkä suomenkielinen teksti jossa puhutaan maasta kansasta ja kielestä kun ihmiset tulevat kaupunkiin he ostavat leipää maitoa ja kalaa",
        "to jest długi tekst w języku polskim który opowiada o kraju i ludziach kiedy przyjechali do miasta kupili chleb mleko i ryby potem poszli do domu",
        "это длинный текст на русском языке который рассказывает о стране и людях когда они приехали в город они купили хлеб молоко и рыбу",
        " ".join("".join(rng.choices("qxzjkwv", k=rng.randint(3, 9))) for _ in range(40)),
    ]
    rows += [(1000 + i, text, None) for i, text in enumerate(odd)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(table)
    assert [r.doc_id for r in language_id.documents_in(table, model).collect()] == [i for i, *_ in rows[:800]]
    assert all(model.predict(text)[0] in words for text in odd)
    blank = table.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.documents_in(blank, language_id.train(blank)).count() == len(rows)


# -- near duplicates -----------------------------------------------------------------------------
def shingles(text, size):
    w = WORD.findall(lower(text or ""))
    return frozenset(zip(*(w[i:] for i in range(size)), strict=False)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def plain_groups(rows, size):
    sets = {k: shingles(t, size) for k, (_, t) in enumerate(rows)}
    root = {k: k for k in sets}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            root[top(a)] = top(b)
    ids = collections.defaultdict(list)
    for k in sets:
        ids[top(k)].append(rows[k][0])
    smallest = {k: min((i for i in ids[top(k)] if i is not None), default=None) for k in sets}
    return collections.Counter((rows[k][0], len(sets[k]), smallest[k], smallest[k] == rows[k][0]) for k in sets)


@pytest.mark.parametrize(("size", "small_band"), [(2, 24), (5, 24), (2, 1)])
def test_near_duplicates(docs, monkeypatch, size, small_band):
    monkeypatch.setattr(near_duplicates, "SMALL_BAND", small_band)
    monkeypatch.setattr(near_duplicates, "BLOCK", 3)
    groups = near_duplicates.near_duplicate_groups(docs, size).drop("class_id")
    assert collections.Counter(map(tuple, groups.collect())) == plain_groups(pairs(docs), size)


def test_without_near_duplicates(spark, docs):
    docs = docs.filter("doc_id is not null")
    kept = near_duplicates.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    component = {row[0]: row[2] for row in plain_groups(pairs(docs), 5)}
    got = [component[r.doc_id] for r in kept.collect()]
    assert sorted(got) == sorted(set(component.values()))
    assert near_duplicates.without_near_duplicates(empty(docs)).count() == 0
    # Repeated rows and rows without id: one row of each group stays; a column named like the row key stays too.
    text, other = " ".join(f"w{i}" for i in range(40)), "other words here " * 10
    rows = [(1, text, 7), (1, text, 7), (None, text, 7), (None, other, 7), (None, other, 7), (2, "", 7), (3, None, 7)]
    table = spark.createDataFrame(rows, "doc_id long, text string, _row long")
    got = [tuple(r) for r in near_duplicates.without_near_duplicates(table).collect()]
    assert sorted(got, key=str) == sorted([(1, text, 7), (None, other, 7), (2, "", 7), (3, None, 7)], key=str)


def test_block_counts():
    rng = np.random.default_rng(0)
    x = [np.unique(rng.integers(0, 400, rng.integers(1, 200), dtype=np.uint64)) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in x[3:]] for a in x]
    assert near_duplicates.common_counts(x, x[3:], columns=50).tolist() == want


# -- language model ------------------------------------------------------------------------------
@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_elias_fano(n):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, 1 << 40, n, dtype=np.uint64) // np.uint64(1 << 20) * np.uint64(37))
    sequence = Sequence(*Sequence.code(values, 1 << 40))
    asked = np.append(values, rng.integers(0, 1 << 40, 50, dtype=np.uint64))
    assert sequence.find(asked).tolist() == np.searchsorted(values, asked).tolist()
    assert sequence.at(np.arange(n)).tolist() == values.tolist()
    if n > 100:
        first, last = np.full(len(asked), 20), np.full(len(asked), 70)
        assert sequence.find(asked, first, last).tolist() == (np.searchsorted(values[20:70], asked) + 20).tolist()


@pytest.mark.parametrize("hot", [2000, 5])
def test_language_model(docs, monkeypatch, hot):
    monkeypatch.setattr(ngram_trie, "HOT_SHARES", hot)
    rows = pairs(docs)
    learned = F.coalesce("doc_id", F.lit(0)) % 3 != 1
    lists = [(i, (i or 0) % 3 != 1, [*WORD.findall(lower(t or "")), ""]) for i, t in rows]
    uni, bi = collections.Counter(), collections.Counter()
    for _, seen, w in lists:
        if seen:
            uni.update(w)
            bi.update(zip([" ", *w], w, strict=False))
    n, v, k = uni.total(), len(uni), ngram_trie.PRIOR
    starts = sum(seen for _, seen, _ in lists)
    want = sorted(
        (
            -1 if i is None else i, seen, len(w), sum(uni[x] > 0 for x in w), n,
            sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w),
            sum(
                math.log10((bi[a, b] + k * (uni[b] + 1) / (n + v + 1)) / ((starts if a == " " else uni[a]) + k))
                for a, b in zip([" ", *w], w, strict=False)
            ),
        )
        for i, seen, w in lists
    )
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, ngram_trie.scored_texts(docs, learned).collect()))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        # One byte per probability: a hundredth of a decade per token.
        assert abs(g[6] - w[6]) <= 0.02 * w[2]
    assert ngram_trie.scored_texts(empty(docs), F.lit(True)).count() == 0
    assert {r.n_known for r in ngram_trie.scored_texts(docs, F.lit(False)).collect()} == {0}


# -- byte-level BPE ----------------------------------------------------------------------------------
def test_byte_bpe(docs):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    extra = ["".join(rng.choices("etaoin ", k=400)).replace(" ", "") for _ in range(20)] + ["a" * 3000, " " * 700, "ab" * 900, "日本語" * 60]
    table = docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame(list(enumerate(extra, 900)), "doc_id long, text string"))
    want = collections.Counter()
    for i, text in pairs(table):
        ids = library.encode_ordinary(text or "")
        raw = struct.pack(f"<{len(ids)}I", *ids)
        want[i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    got = byte_bpe.encoded(table, path, public_tokenizers.PATTERN, digests=True)
    assert collections.Counter(map(tuple, got.collect())) == want
    whole = byte_bpe.encoded(table, path, public_tokenizers.PATTERN).collect()
    assert collections.Counter(bytes(r.decoded).decode() for r in whole) == collections.Counter(t or "" for _, t in pairs(table))
    assert byte_bpe.encoded(empty(docs), path, public_tokenizers.PATTERN, digests=True).count() == 0


@pytest.fixture(scope="module")
def bpe():
    """A tokenizer of its own, and the library's ids."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    merges = byte_bpe.merge_rows(ranks)
    return lambda: byte_bpe.Bpe(ranks, merges, public_tokenizers.PATTERN), library.encode_ordinary


def ids_of(rows):
    return [np.frombuffer(bytes.fromhex(x), "<u4").tolist() for x in rows.column("ids").to_pylist()]


def test_byte_bpe_many_words_of_many_rounds(bpe):
    """Takes a row per word and round; a row per token and round ran out of memory."""
    rng = random.Random(3)
    text = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=63)) for _ in range(20_000))
    text += " aaa bbbbb abababab " + " ".join("a" * n for n in range(1, 64))
    make, encode = bpe
    assert ids_of(make().documents([text], digests=False)) == [encode(text)]


def test_byte_bpe_sorts_documents_only(bpe, tmp_path):
    """Words come in their order; of rows that are sorted there is one for each document."""
    rng = random.Random(4)
    # Later texts bring new words, repeat known ones and hold some of the first text's words only.
    texts = [" ".join("".join(rng.choices("etaoins", k=rng.randint(1, 9))) for _ in range(3000)) for _ in range(6)]
    make, encode = bpe
    own = make()
    own.documents(texts[:3])
    profile = tmp_path / "profile.json"
    own.db.execute("PRAGMA enable_profiling = 'json'")
    own.db.execute(f"PRAGMA profiling_output = '{profile}'")
    found = own.documents(texts[::-1], digests=False)
    own.db.execute("PRAGMA disable_profiling")
    assert ids_of(found) == [encode(text) for text in texts[::-1]] and not own.strict

    def sorted_rows(node):
        mine = node["intermediate_rows"] if node["type"] == "ORDER_BY" else 0
        return mine + sum(map(sorted_rows, node.get("children", [])))

    nodes = json.loads(profile.read_text())["operator"]
    assert 0 < sum(map(sorted_rows, nodes)) <= len(texts)


# -- personal data ---------------------------------------------------------------------------------
def plain_spans(text):
    spans = [(0, m.start(), m.end()) for m in personal_data.EMAIL.finditer(text)]
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    spans += [(1, m.start(), m.end()) for m in ip.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, low, high in ((2, personal_data.CARD, 13, 19), (3, personal_data.PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            checked = kind == 3 or sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(digits[::-1])) % 10 == 0
            if low <= len(digits) <= high and checked:
                spans.append((kind, m.start(), m.end()))
    return spans


def test_base_spans():
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choices("aB1234567890@..-+ ()%é", k=rng.randint(0, 60)))
        assert personal_data.base_spans(text) == plain_spans(text)
    assert personal_data.base_spans("1" * 200_000) == personal_data.base_spans(None) == []


def test_personal_data(spark, docs):
    texts = ["mail me at a.b@mail1.example.com or +1 (456) 555-2186 now", "card 4539 1488 0343 6467, ip 10.0.0.255 and 300.1.1.1",
             "please call (303) 555-0123 today", "token = \"d48fd8e940a86f41832370bc4dd81bc9d95bf72b\" 9807915762804490", "in 2019 we sold 12 of 45"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_chars", F.length("text"))
    field = personal_data.train(table.unionByName(docs.select("doc_id", "text", F.lit(0).alias("n_chars"))))
    rows = {r.doc_id: r for r in personal_data.personal_spans(table, field).collect()}
    assert (rows[0].n_email, rows[0].n_phone, rows[1].n_card, rows[1].n_ip) == (1, 1, 1, 1)
    assert rows[2].spans == "phone:12:26" and rows[2].n_phone == 0
    assert rows[3].spans == rows[4].spans == ""
    for i, text in enumerate(texts):
        spans = plain_spans(text)
        assert rows[i].base_sha256 == hashlib.sha256(personal_data.joined(spans).encode()).hexdigest()
        assert set(personal_data.joined(spans).split(",")) - {""} <= set(rows[i].spans.split(","))
    clean = {r.doc_id: r for r in personal_data.without_personal_data(table, field).collect()}
    assert clean[0].text == "mail me at <email> or <phone> now" and clean[0].n_chars == len(clean[0].text)
    assert clean[4].text == texts[4]
    assert personal_data.personal_spans(docs, field).count() == docs.count()
    assert personal_data.without_personal_data(docs, field).columns == docs.columns
    assert personal_data.personal_spans(empty(docs), personal_data.train(empty(docs))).count() == 0


def test_no_spans_added_to_clean_prose(spark):
    """Documents of sf0.1 without a digit, @ or spelled-out dot get no span: sentence ends after "at" are no hosts."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    field = personal_data.train(docs)
    clean = docs.filter(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[0-9@]|\(dot\)|\[dot\]|(?<= )dot(?= )"))
    assert clean.count() > 1000
    assert personal_data.personal_spans(clean, field).filter("spans != ''").count() == 0
    # The sentence ends that used to be taken for addresses.
    prose = ["is of at and. The end", "a in at and. Thannd", "Reen st. At and. Rean"]
    table = spark.createDataFrame(list(enumerate(prose)), "doc_id long, text string")
    assert {r.spans for r in personal_data.personal_spans(table, field).collect()} == {""}


def test_spelled_out_addresses(spark):
    """An address without a digit or ``@`` is found where it stands alone, and plain words are not."""
    texts = ["jane.doe at example dot com", "please write to max (at) example.org before the week ends", "info [at] example [dot] net",
             "they met at the gate and looked at the garden", "a dot on the map"]
    more = [f"we sat at the {w} and looked at every {w} there" for w in ("table", "window", "river", "station")]
    table = spark.createDataFrame(list(enumerate(texts + more)), "doc_id long, text string")
    field = personal_data.train(table)
    got = {r.doc_id: r.text for r in personal_data.without_personal_data(table, field).collect()}
    assert got[0] == got[2] == "<email>" and got[1] == "please write to <email> before the week ends"
    assert all(got[i] == text for i, text in enumerate(texts + more) if i > 2)


# -- packing -----------------------------------------------------------------------------------------
def test_fullest():
    rng = random.Random(5)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(4)}
        room = rng.randint(1, 80)
        sums = {sum(n * x for n, x in zip(c, counts, strict=True)) for c in itertools.product(*(range(n + 1) for n in counts.values()))}
        taken = packing.fullest(sorted(counts, reverse=True), counts, room)
        assert sum(x * n for x, n in taken) == max(s for s in sums if s <= room)
        assert all(n <= counts[x] for x, n in taken)


@pytest.mark.parametrize("group_rows", [200_000, 7])
def test_packing(docs, monkeypatch, group_rows):
    monkeypatch.setattr(packing, "GROUP_ROWS", group_rows)
    path, capacity = public_tokenizers.path("word_bpe_49k.json"), 512
    library = Tokenizer.from_file(path)
    want = collections.Counter()
    for i, text in pairs(docs):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[i, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    rows = packing.packed_documents(docs, path, capacity).collect()
    assert collections.Counter(tuple(r)[:5] for r in rows) == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == list(itertools.accumulate([0] + [n for _, n in parts]))[:-1]
        assert sum(n for _, n in parts) <= capacity
    assert len(bins) <= -(-sum(r.length for r in rows) // capacity) + 1
    assert packing.packed_documents(empty(docs), path).count() == 0


def test_packing_special_strings_as_the_library():
    """Special tokens in a text are what the library makes of them with add_special_tokens=False."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["hello <|endoftext|> world", "<|startoftext|>x", "plain words only", "<|ENDOFTEXT|> <|end"]
    got = packing.Encoder(path).encode(texts)
    assert got == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert np.frombuffer(got[0], "<u4").tolist() == [3306, 49407, 1002]


def test_letters_are_unicode_letters():
    """Numbers that Python calls alphanumeric are no letters: such a text is und."""
    model = language_id.LanguageModel({"en": np.ones((2, language_id.BUCKETS), np.float32)})
    assert model.predict("½ ² Ⅷ") == ("und", 0.0) and model.predict("") == ("und", 0.0)
    assert quality_rules.LETTER.search("ß") and not quality_rules.LETTER.search("½²Ⅷ١")
