"""Spans of pattern matches with their positions, in built-in expressions.

Spark's regular expression functions return matches, not positions. Splitting
a text at a pattern gives the pieces between the matches, so the lengths of
pieces and matches, added up in order, are the positions (in code points).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlake.llm.common import let

#: Elements that a scan collects before it hands them on, and how often these are collected again.
BLOCK, LEVELS = 16, 4

#: One proposal: code point positions (end exclusive) and the match.
PROPOSAL = "struct<start:int,end:int,value:string>"
#: A proposal with the text around it; ``lead`` and ``trail`` are what stands before
#: and after the whole run of proposals that it belongs to, null where it stands alone.
PLACED = "struct<start:int,end:int,value:string,before:string,after:string,lead:string,trail:string>"
#: One accepted span; rank orders kinds that start at the same place.
SPAN = "struct<start:int,rank:int,kind:string,end:int,score:int,value:string>"
CONTEXT = 48  # code points of context kept on each side of a proposal
#: Fixed value: what may stand between the proposals of a run: no letters or digits but an "and", "or" or list number.
BETWEEN = r"^[^\p{L}\p{N}]*+(?:(?:(?i:and|or|und|oder|et|ou|y|o)|[0-9]{1,3})[^\p{L}\p{N}]++)?\z"


def no(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def hits(text: Column, pattern: str, only_if: Column) -> Column:
    """Leftmost non-overlapping matches. ``only_if`` must hold for every text
    that has a match; it saves the search in the others."""
    return F.when(only_if, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(no("string"))


def pieces(text: Column, pattern: str, found: Column) -> Column:
    """What stands before, between and after the matches."""
    return F.when(F.size(found) > 0, F.split(text, pattern, -1)).otherwise(no("string"))


def scan(rows: Column, state: Column, output: str, step) -> Column:
    """array<output> of the second results of ``step(state, row) -> (state, output)``, the state handed on
    from row to row.

    An aggregate copies what it has gathered at every step, so one array of all outputs would cost
    the square of the rows. Here outputs are gathered in blocks, blocks in blocks of blocks, and so
    on: an output is copied at most ``BLOCK`` times on each level, and rows / 8192 times on the last.
    """
    def cut(given: Column, size: int) -> Column:
        last = F.floor((F.size(given) - 1) / size).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(given, b * size + 1, F.lit(size)))

    def nested(given: Column, level: int) -> Column:
        return given if level == 1 else F.transform(cut(given, BLOCK ** (level - 1)), lambda part: nested(part, level - 1))

    def gathered(part: Column, before: Column, level: int, finish) -> Column:
        kind = f"{'array<' * (level - 1)}{output}{'>' * (level - 1)}"

        def add(acc: Column, x: Column) -> Column:
            if level == 1:
                after, made = step(acc["state"], x)
                return F.struct(after.alias("state"), F.concat(acc["out"], F.array(made)).alias("out"))
            return gathered(x, acc["state"], level - 1, lambda d: F.struct(d["state"].alias("state"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

        return F.aggregate(part, F.struct(before.alias("state"), no(kind).alias("out")), add, finish)

    done = gathered(nested(rows, LEVELS), state, LEVELS, lambda d: d["out"])
    for _ in range(LEVELS - 1):
        done = F.flatten(done)
    return F.when(F.size(rows) > 0, done).otherwise(no(output))


def proposals(found: Column, between: Column) -> Column:
    """array<PROPOSAL> from matches and pieces."""
    rows = F.arrays_zip(found.alias("value"), F.slice(between, F.lit(1), F.size(found)).alias("before"))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + F.length(x["before"])
        end = start + F.length(x["value"])
        return end, F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))

    return F.when(F.size(found) > 0, let(rows, lambda r: scan(r, F.lit(0), PROPOSAL, step))).otherwise(no(PROPOSAL))


def placed(found: Column, between: Column) -> Column:
    """array<PLACED> from proposals and pieces: ``CONTEXT`` code points of the whole
    text on both sides, across neighbouring matches, and the context of the run."""
    kept = "struct<start:int,end:int,value:string,before:string,after:string,joined:boolean,lead:string>"
    rows = F.transform(
        F.arrays_zip(found.alias("p"), F.slice(between, F.lit(1), F.size(found)).alias("before"), F.slice(between, F.lit(2), F.size(found)).alias("after")),
        lambda x: F.struct(
            x["p"].alias("p"), F.right(x["before"], F.lit(CONTEXT)).alias("before"), F.left(x["after"], F.lit(CONTEXT)).alias("after"),
            ((F.length(x["before"]) <= CONTEXT) & x["before"].rlike(BETWEEN)).alias("joins"),
        ),
    )
    last = lambda *parts: F.right(F.concat(*parts), F.lit(CONTEXT))
    first = lambda *parts: F.left(F.concat(*parts), F.lit(CONTEXT))

    def forth(acc: Column, x: Column) -> tuple[Column, Column]:
        before = last(acc["tail"], x["before"])
        joined = x["joins"] & acc["lead"].isNotNull()
        lead = F.when(joined, acc["lead"]).otherwise(before)
        one = F.struct(*[x["p"][c].alias(c) for c in ("start", "end", "value")], before.alias("before"), x["after"].alias("after"), joined.alias("joined"), lead.alias("lead"))
        return F.struct(last(acc["tail"], x["before"], x["p"]["value"]).alias("tail"), lead.alias("lead")), one

    def back(acc: Column, x: Column) -> tuple[Column, Column]:
        after = first(x["after"], acc["head"])
        trail = F.when(acc["joined"], acc["trail"]).otherwise(after)
        one = F.struct(*[x[c].alias(c) for c in ("start", "end", "value", "before")], after.alias("after"),
                       F.when(x["joined"], x["lead"]).alias("lead"), F.when(acc["joined"], trail).alias("trail"))
        return F.struct(first(x["value"], x["after"], acc["head"]).alias("head"), x["joined"].alias("joined"), trail.alias("trail")), one

    none = F.lit(None).cast("string")
    forward = F.struct(F.lit("").alias("tail"), none.alias("lead"))
    backward = F.struct(F.lit("").alias("head"), F.lit(False).alias("joined"), none.alias("trail"))
    ahead = let(rows, lambda r: scan(r, forward, kept, forth))
    both = let(F.reverse(ahead), lambda r: F.reverse(scan(r, backward, PLACED, back)))
    return F.when(F.size(found) > 0, both).otherwise(no(PLACED))


def accepted(found: Column, keep, kind: str, rank: int, score) -> Column:
    """array<SPAN> of the proposals that ``keep`` holds for."""
    return F.transform(
        F.filter(found, keep),
        lambda p: F.struct(
            p["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
            p["end"].alias("end"), score(p).cast("int").alias("score"), p["value"].alias("value"),
        ),
    ).cast(f"array<{SPAN}>")


def listed(spans: Column) -> Column:
    """``kind:start:end`` comma-joined; the array must be sorted."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[KIND]``; overlapping spans become
    one mask, named by the first. The text is split into code points once."""
    reached = "struct<start:int,kind:string,opens:boolean,end:int>"

    def step(end: Column, s: Column) -> tuple[Column, Column]:
        opens = s["start"] >= end
        reach = F.greatest(end, s["end"])
        return reach, F.struct(s["start"].alias("start"), s["kind"].alias("kind"), opens.alias("opens"), reach.alias("end"))

    def masks(found: Column) -> Column:
        """A mask begins with a span that opens and reaches as far as the span before the next that opens."""
        n = F.size(found)
        following = F.concat(F.slice(F.transform(found, lambda f: f["opens"]), F.lit(2), n), F.array(F.lit(True)))
        closing = F.filter(F.arrays_zip(found.alias("f"), following.alias("next")), lambda z: z["next"])
        return F.arrays_zip(F.filter(found, lambda f: f["opens"]).alias("open"), F.transform(closing, lambda z: z["f"]["end"]).alias("end"))

    def rebuild(chars: Column, m: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), F.transform(m, lambda x: x["end"]))
        parts = F.transform(F.arrays_zip(m.alias("m"), F.slice(ends, F.lit(1), F.size(m)).alias("at")), lambda x: F.concat(
            F.array_join(F.slice(chars, x["at"] + 1, x["m"]["open"]["start"] - x["at"]), ""), F.lit("["), F.upper(x["m"]["open"]["kind"]), F.lit("]")))
        rest = F.slice(chars, F.element_at(ends, -1) + 1, F.size(chars))
        return F.concat(F.array_join(parts, ""), F.array_join(rest, ""))

    done = let(scan(spans, F.lit(0), reached, step), lambda found: let(masks(found), lambda m: let(F.split(text, "", -1), lambda chars: rebuild(chars, m))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
