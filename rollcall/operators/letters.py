"""Letters due (J7): which resolved rows get a letter that a ledger of
already-sent addresses does not list.

At most one letter per e-mail (the ledger grows during the reference's run,
so a second row of the same address finds it).  ``match="exact"`` (the
default) compares lower-cased addresses with an anti-join.  ``match="regex"``
keeps the reference's test — the row's address used as an unescaped regular
expression searched in every ledger entry, case-sensitive — in one plan for
every size.  Any entry that an address matches holds a literal piece of the
address (one of several, where it has alternatives), so an address is joined
with the ledger on one n-gram of each piece (8 characters, or 4 for shorter
pieces) and the regular expression is checked on the pairs.  With a kept index
(sources.ledger_index) the ledger's n-grams are looked up, not cut anew.  Only
an address without such a piece meets the ledger through ``SALTS`` salted
shuffle partitions.  In regex mode, as in exact mode, letters planned earlier in
the same batch suppress only the same address.
"""

from __future__ import annotations

import re
from re import _parser as regex_parser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import email_key
from rollcall.operators.ordered import first_per_key


GRAMS = (8, 4)  # lengths of the n-grams, the longest first
SALTS = 64


def grams_of(text, n: int):
    """All n-grams of a text."""
    last = F.length(text) - n + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                                         lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def _longest_literal(pattern):
    """The longest run of plain characters that every match of ``pattern``
    must hold; for patterns without alternatives, classes, groups, escapes,
    anchors or counts.  A character before ``*`` or ``?`` is optional."""
    plain = F.regexp_replace(pattern, "(?s).[*?]", ".")
    pieces = F.split(plain, r"[.+*?]")
    return F.aggregate(pieces, F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))


_SPECIAL = r"[|()\[\]{}\\^$]"
# escapes of a letter that mean the same to Python's parser and to the JVM's
_SAME_ESCAPES = set("dDwWsSbBtnrf")


def required_literals(pattern: str | None) -> list[str]:
    """Texts of which every match of the regular expression holds at least
    one; empty where none can be told.  Alternatives, groups and counts are
    followed; what isn't a plain character (classes, anchors, references) only
    ends a run."""
    if pattern is None or "(?" in pattern.replace("(?:", "") or any(
            b.isalnum() and b not in _SAME_ESCAPES for b in re.findall(r"\\(.)", pattern)):
        return []

    def best(seq) -> list[str] | None:
        found: list[list[str]] = []
        run = ""
        for op, arg in [*seq, (None, None)]:
            if op is regex_parser.LITERAL:
                run += chr(arg)
                continue
            if run:
                found.append([run])
                run = ""
            inner = None
            if op is regex_parser.SUBPATTERN:
                inner = best(arg[-1])
            elif op is regex_parser.BRANCH:
                parts = [best(a) for a in arg[1]]
                inner = [x for p in parts for x in p] if all(parts) else None
            elif op in (regex_parser.MAX_REPEAT, regex_parser.MIN_REPEAT) and arg[0] > 0:
                inner = best(arg[2])
            if inner:
                found.append(inner)
        return max(found, key=lambda f: min(map(len, f))) if found else None

    try:
        return best(regex_parser.parse(pattern)) or []
    except (re.error, OverflowError, RecursionError):
        return []


def _pieces(pattern):
    """``required_literals`` as a column; plain patterns stay in the JVM."""
    special = pattern.rlike(_SPECIAL)
    parsed = F.udf(lambda p: required_literals(p), "array<string>")(F.when(special, pattern))
    return F.when(special, parsed).otherwise(F.array(_longest_literal(pattern)))


def _regex_matched(cand: DataFrame, sent: DataFrame, index=None) -> DataFrame:
    """(event_id, pos) of the candidates whose address, as a regular
    expression, is found in an entry of ``sent`` (column ``_sent``), or of the
    ledger's kept ``index`` (sources.ledger_index)."""
    asked = cand.select("event_id", "pos", "email", _pieces(F.col("email")).alias("_pieces"))
    usable = (F.size("_pieces") > 0) & F.forall("_pieces", lambda p: F.length(p) >= GRAMS[-1])

    def gram(piece):
        """A piece's n-gram with the smallest hash (spreads common ones), of
        the longest length that fits."""
        out = F.lit(None).cast("string")
        for n in reversed(GRAMS):
            one = F.array_min(F.transform(grams_of(piece, n), lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g"))))
            out = F.when(F.length(piece) >= n, one["g"]).otherwise(out)
        return out

    mine = asked.where(usable).select("event_id", "pos", "email",
                                      F.explode(F.transform("_pieces", gram)).alias("gram"))
    if index is None:
        entries = sent.distinct()
        lengths = F.array_distinct(F.concat(*[grams_of(F.col("_sent"), n) for n in GRAMS]))
        theirs = entries.select("_sent", F.explode(lengths).alias("gram"))
    else:
        entries = index.entries().withColumnRenamed("sent", "_sent")
        theirs = index.holding(mine).withColumnRenamed("sent", "_sent")
    rest = asked.where(~usable).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = entries.withColumn("_salt", F.pmod(F.hash("_sent"), F.lit(SALTS)))
    found = [mine.join(theirs, "gram"), rest.join(salted.hint("shuffle_hash"), "_salt")]
    hits = [f.where(F.regexp(F.col("_sent"), F.col("email"))).select("event_id", "pos") for f in found]
    return hits[0].unionByName(hits[1])


def letter_candidates(resolved: DataFrame) -> DataFrame:
    """First row per e-mail key: (e, event_id, pos, email, account)."""
    first = first_per_key(resolved, ["e"], ["event_id", "pos"], ["email", "account"], prefix="")
    return first


def unsent(resolved: DataFrame | None, ledger: DataFrame | None, letter: str, match: str = "exact",
           column: str = "Email", candidates: DataFrame | None = None, index=None) -> DataFrame:
    """Outbox rows: event_id, pos, account, email, letter.  ``candidates``
    (``letter_candidates``) may be passed when several ledgers share them;
    ``index`` is the ledger's kept index (regex mode; ``ledger`` isn't read)."""
    cand = candidates if candidates is not None else letter_candidates(resolved)
    if match == "exact":
        # the ledger only grows; look up just this batch's addresses (a
        # broadcast semi-join), so the anti-join never shuffles it whole
        sent = (ledger.select(email_key(column).alias("_sent")).where(F.col("_sent").isNotNull())
                .join(cand.select(F.col("e").alias("_sent")), "_sent", "left_semi"))
        due = cand.join(sent, cand["e"] == sent["_sent"], "left_anti")
    elif match == "regex":
        sent = (ledger.select(F.col(column).alias("_sent")).where(F.col("_sent").isNotNull())
                if index is None else None)
        due = cand.join(_regex_matched(cand, sent, index), ["event_id", "pos"], "left_anti")
    else:
        raise ValueError(f"unknown match mode {match!r}")
    return due.select("event_id", "pos", "account", "email", F.lit(letter).alias("letter"))
