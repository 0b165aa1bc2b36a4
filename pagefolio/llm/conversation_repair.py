"""Conversation structure repair by a grammar-compressed dynamic programme.

A repaired conversation has role initials ``(s?(ua)+)?``: an optional system turn, then pairs of
user and assistant. Each row may be kept (cost 0), given the role user or assistant (3), or deleted
(4, and required for blank and duplicate rows); empty user or assistant rows may be inserted
anywhere (3 each); a truncated row that stays costs 3 more. The cheapest edits are found by a
min-plus product of 4 x 4 transfer matrices over the states of that pattern (start, after system,
after user, after assistant). An entry holds the cost and the audit (the edits' initials) of the best
way between two states; among equal costs the ASCII-least audit wins, which a product keeps, since
two equal-cost audits over the same rows never extend one another.

Rows are first reduced to symbols (role initial, and blank or duplicate, truncated, or sound), so a
conversation is a string over nine letters. Re-Pair, run as Spark jobs over the strings of all
conversations, replaces the most frequent adjacent pairs by new symbols, a round of ``PAIRS_PER_ROUND``
pairs per job, until no pair occurs twice or ``MAX_RULES`` rules exist. The matrix of each rule is
the product of its two parts, computed once, bottom-up, and shared by every conversation; a
conversation then multiplies the matrices of its compressed string. The grammar changes only the
speed: any grammar gives the same result.

What moves: damage, faults (a window per role and text finds duplicates), symbols and the order
of a conversation's rows are Spark expressions; a conversation becomes one row of its sorted rows
(the contract's digest of the repaired conversation is one sequential hash over its rows, so a
conversation is not split). Re-Pair pair counts are partial aggregates, and only the
``PAIRS_PER_ROUND`` best pairs of a round come to the driver. The programme runs once per distinct
compressed string, which conversations share, in Arrow batches; each conversation then only
replays its audit and hashes its repaired rows.

Cases: null conv_id is one conversation of its own; null role or text is one space, before damage;
null turns sort first; rows of equal turn sort by role and text, and equal rows are copies (the
first is the original); a conversation whose rows all drop gives zeros, an empty audit and the
digest of the empty text; an empty table gives no rows; very long texts only enter digests and
regular expressions; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagefolio.llm.text import slices
from pagefolio.sources.scratch import size_checked, written

# Fixed values of the contract: damage by crc32 of `conv_id:turn` mod 20, and the edit costs.
DROP, EMPTY, UNPUNCTUATE, REPEAT, AS_USER = 0, 1, 2, 3, 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SENTENCE_END = "[.!?]"
BLANK = re.compile(r"[^\x20\x09-\x0D]")
# Re-Pair: rules per Spark job, and the most rules (more only save time).
PAIRS_PER_ROUND = 32
MAX_RULES = 128

START, AFTER_S, AFTER_U, AFTER_A = range(4)
ACCEPTING = (START, AFTER_A)
NEXT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
LEGAL_PAIRS = {"su", "ua", "au"}
# Terminal symbols: F is a row that must go; the others a role initial (o: any other) and
# t (truncated) or n (sound).
TERMINALS = {"F": None} | {f"{r}{t}": None for r in "suao" for t in "tn"}
LETTER = dict(zip(TERMINALS, "ABCDEFGHI"))
FIRST_RULE = 0x100

RESULT_DDL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string, n_rows long"
)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage: ``conv_id, turn, role, text``; code 3 rows twice."""
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    code = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    role = F.coalesce(F.col("role"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"), code.alias("_code"))
    rows = rows.filter(F.col("_code") != DROP).select(
        "conv_id", "turn",
        F.when(F.col("_code") == AS_USER, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_code") == EMPTY, F.lit(""))
        .when(F.col("_code") == UNPUNCTUATE, F.regexp_replace("text", SENTENCE_END, ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("_code") == REPEAT, 2).otherwise(1))).alias("_copy"),
    )
    return rows.drop("_copy")


def _ordered(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows by turn (nulls first), role and text."""
    rows = rows.assign(_null=rows["turn"].notna())
    return rows.sort_values(["_null", "turn", "role", "text"], kind="stable", na_position="first").reset_index(drop=True)


def faults(rows: pd.DataFrame) -> list[str]:
    """The first fault of each ordered row: ``blank``, ``duplicate``, ``truncated`` or empty."""
    seen: set[tuple[str, str]] = set()
    out = []
    for role, text in zip(rows["role"], rows["text"]):
        if not BLANK.search(text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
            fault = "truncated"
        else:
            fault = ""
        seen.add((role, text))
        out.append(fault)
    return out


def symbols(rows: pd.DataFrame, fault: list[str]) -> str:
    """The terminal letters of ordered rows."""
    out = []
    for role, f in zip(rows["role"], fault):
        if f in ("blank", "duplicate"):
            out.append(LETTER["F"])
        else:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            out.append(LETTER[initial + ("t" if f == "truncated" else "n")])
    return "".join(out)


# -- min-plus matrices of (cost, audit) ---------------------------------------------------------

Matrix = list[list[tuple[int, str] | None]]


def _better(a, b):
    return a if b is None or (a is not None and (a[0], a[1]) <= (b[0], b[1])) else b


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = [[None] * 4 for _ in range(4)]
    for i in range(4):
        for k in range(4):
            x = a[i][k]
            if x is None:
                continue
            for j in range(4):
                y = b[k][j]
                if y is not None:
                    out[i][j] = _better((x[0] + y[0], x[1] + y[1]), out[i][j])
    return out


def _inserts() -> Matrix:
    """Any number of inserted rows: the cheapest way between two states."""
    m: Matrix = [[(0, "") if i == j else None for j in range(4)] for i in range(4)]
    for _ in range(3):
        step: Matrix = [[None] * 4 for _ in range(4)]
        for (state, role), nxt in NEXT.items():
            if role != "s":
                step[state][nxt] = (INSERT, "I")
        for i in range(4):
            step[i][i] = (0, "")
        m = product(m, step)
    return m


INSERTS = _inserts()


def terminal(symbol: str) -> Matrix:
    """Inserts, then the choices for one row of this terminal symbol."""
    choice: Matrix = [[None] * 4 for _ in range(4)]
    for state in range(4):
        choice[state][state] = (DELETE, "D")
    if symbol != "F":
        initial, extra = symbol[0], TRUNCATED if symbol[1] == "t" else 0
        for state in range(4):
            if (state, initial) in NEXT:
                nxt = NEXT[state, initial]
                choice[state][nxt] = _better((KEEP + extra, "K"), choice[state][nxt])
            for role in ("u", "a"):
                if (state, role) in NEXT:
                    nxt = NEXT[state, role]
                    choice[state][nxt] = _better((REROLE + extra, "R"), choice[state][nxt])
    return product(INSERTS, choice)


def rule_matrices(rules: list[tuple[str, str, str]]) -> dict[str, Matrix]:
    """Matrices of the terminals and of every rule, bottom-up (a rule only uses earlier symbols)."""
    matrices = {LETTER[t]: terminal(t) for t in TERMINALS}
    for symbol, left, right in rules:
        matrices[symbol] = product(matrices[left], matrices[right])
    return matrices


def compress(string: str, rules: list[tuple[str, str, str]]) -> str:
    for symbol, left, right in rules:
        if left + right in string:
            string = string.replace(left + right, symbol)
    return string


def cheapest(string: str, matrices: dict[str, Matrix]) -> tuple[int, str]:
    """Cost and audit of the best repair of a compressed symbol string, from the start state."""
    vector = [(0, "") if s == START else None for s in range(4)]
    for symbol in string:
        m = matrices[symbol]
        new = [None] * 4
        for i, x in enumerate(vector):
            if x is None:
                continue
            for j in range(4):
                y = m[i][j]
                if y is not None:
                    new[j] = _better((x[0] + y[0], x[1] + y[1]), new[j])
        vector = new
    best = None
    for i, x in enumerate(vector):
        if x is None:
            continue
        for j in ACCEPTING:
            y = INSERTS[i][j]
            if y is not None:
                best = _better((x[0] + y[0], x[1] + y[1]), best)
    return best


def repaired(rows: pd.DataFrame, audit: str) -> list[str]:
    """``role:text`` of the repaired rows, by replaying the audit on the states of the pattern."""
    return replayed(list(rows["role"]), list(rows["text"]), audit)


def replayed(roles: list[str], texts: list[str], audit: str) -> list[str]:
    """``role:text`` of the repaired rows of ordered rows; a kept or rerolled row keeps its text."""
    out, state, r = [], START, 0
    for edit in audit:
        if edit == "I":
            role = "user" if (state, "u") in NEXT else "assistant"
            state = NEXT[state, role[0]]
            out.append(f"{role}:")
            continue
        role, text = roles[r], texts[r]
        r += 1
        if edit == "K":
            state = NEXT[state, role[0]]
            out.append(f"{role}:{text}")
        elif edit == "R":
            role = "user" if (state, "u") in NEXT else "assistant"
            state = NEXT[state, role[0]]
            out.append(f"{role}:{text}")
    return out


def with_symbols(rows: DataFrame) -> DataFrame:
    """Damaged rows with their first fault and terminal letter, as Spark expressions.

    A row is a duplicate if an earlier row of its conversation has its role and text: the rows of
    one role and text are numbered in conversation order (equal rows are copies, any of them may
    come first).
    """
    earlier = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").isNotNull(), "turn")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    truncated = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = (
        F.when(blank, "blank").when(F.row_number().over(earlier) > 1, "duplicate")
        .when(truncated, "truncated").otherwise("")
    )
    initial = F.when(F.col("role").startswith("s"), "s").when(F.col("role").startswith("u"), "u") \
        .when(F.col("role").startswith("a"), "a").otherwise("o")
    rows = rows.withColumn("fault", fault)
    kind = F.concat(initial, F.when(F.col("fault") == "truncated", "t").otherwise("n"))
    letter = F.lit(LETTER["F"])
    for name, value in LETTER.items():
        if name != "F":
            letter = F.when(kind == name, value).otherwise(letter)
    return rows.withColumn("sym", F.when(F.col("fault").isin("blank", "duplicate"), LETTER["F"]).otherwise(letter))


def conversation_rows(rows: DataFrame) -> DataFrame:
    """One row per conversation: its ordered rows, symbol string and counts."""
    # Equal rows are copies: the one that is no duplicate comes first.
    ordered = F.sort_array(F.collect_list(F.struct(
        F.col("turn").isNotNull().alias("k"), "turn", "role", "text", (F.col("fault") == "duplicate").alias("d"), "sym")))
    n_turns = F.count_distinct("turn")
    return rows.groupBy("conv_id").agg(
        ordered.alias("rows"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - n_turns, F.lit(0)).cast("long").alias("gaps"),
        *[F.sum((F.col("fault") == f).cast("long")).alias(f) for f in ("blank", "duplicate", "truncated")],
    ).withColumn("s", F.array_join(F.transform("rows", lambda x: x["sym"]), ""))


def grammar(strings: DataFrame, max_rules: int = MAX_RULES, per_round: int = PAIRS_PER_ROUND) -> list[tuple[str, str, str]]:
    """Re-Pair rules ``(symbol, left, right)`` over the strings of all conversations, in Spark rounds."""
    rules: list[tuple[str, str, str]] = []
    current = strings.select("s").filter(F.length("s") >= 2)
    while len(rules) < max_rules:
        pairs = current.select(F.explode(F.expr("transform(sequence(1, length(s) - 1), i -> substring(s, i, 2))")).alias("p"))
        top = pairs.filter(F.length("p") == 2).groupBy("p").count().filter("count >= 2").orderBy(F.desc("count"), "p").limit(
            min(per_round, max_rules - len(rules))).collect()
        if not top:
            break
        expr = F.col("s")
        for row in top:
            symbol = chr(FIRST_RULE + len(rules))
            rules.append((symbol, row.p[0], row.p[1]))
            expr = F.replace(expr, F.lit(row.p), F.lit(symbol))
        current = written(current.select(expr.alias("s")).filter(F.length("s") >= 2), "repair_strings")
    return rules


def repaired_conversations(conversations: DataFrame, max_rules: int = MAX_RULES) -> DataFrame:
    """One row per conv_id of ``conversations (conv_id, turn, role, text)``, as the module states."""
    convs = written(conversation_rows(with_symbols(damaged(conversations))), "repair_conversations")
    rules = grammar(convs.select("s"), max_rules)
    matrices = rule_matrices(rules)
    compressed = F.col("s")
    for symbol, left, right in rules:
        compressed = F.replace(compressed, F.lit(left + right), F.lit(symbol))
    convs = convs.withColumn("c", compressed)

    # The programme runs once per distinct compressed string; conversations share them.
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [cheapest(c, matrices) for c in batch.column(0).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([f[0] for f in found], pa.int64()),
                                   pa.array([f[1] for f in found], pa.string())], ["c", "cost", "audit"])

    solved = written(convs.select("c").distinct().mapInArrow(solve, "c string, cost long, audit string"), "repair_solved")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                illegal, sha = [], []
                for rows, audit in zip(part.column("rows").to_pylist(), part.column("audit").to_pylist(), strict=True):
                    roles = [r["role"] for r in rows]
                    initials = [r[:1] for r in roles]
                    illegal.append(sum(1 for x, y in zip(initials, initials[1:]) if x + y not in LEGAL_PAIRS))
                    lines = replayed(roles, [r["text"] for r in rows], audit)
                    sha.append(hashlib.sha256("\n".join(lines).encode()).hexdigest())
                yield pa.record_batch(
                    [part.column(c) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated")]
                    + [pa.array(illegal, pa.int64()), part.column("cost"), part.column("audit"), pa.array(sha, pa.string())],
                    ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
                )

    joined = convs.join(size_checked(solved), "c").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "cost", "audit", "rows")
    found = joined.mapInArrow(digest, RESULT_DDL.rsplit(", n_rows long", 1)[0])
    every = conversations.select(F.col("conv_id").cast("long")).distinct()
    empty = hashlib.sha256(b"").hexdigest()
    return every.join(found, every["conv_id"].eqNullSafe(found["conv_id"]), "left").select(every["conv_id"], *[
        F.coalesce(found[c], F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ], F.coalesce(found["audit"], F.lit("")).alias("audit"), F.coalesce(found["repaired_sha256"], F.lit(empty)).alias("repaired_sha256"))
