"""Declarations of interests: the sections of a text as one ordered fold over its lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.names import strip_accents
from vitrine.functions.numbers import amounts_in

# The sections, each with the phrases (folded, without blanks) of which any opens it.
SECTIONS = (
    ("actionariat", ("asociatsauactionar", "asociatsiactionar")),
    ("conducere", ("organeledeconducere", "calitateademembruinorganele")),
    ("prof_sindicat", ("asociatiilorprofesionale", "profesionalesi", "sindicale")),
    ("partid", ("partidelorpolitice", "partiduluipolitic")),
    ("contracte", ("contracteinclusiv", "contracte,inclusiv", "asistentajuridica", "finantatedela")),
)
# What the printed form itself says (folded, without blanks), and what only its sentences say.
FORM = (
    "unitatea", "denumireasiadresa", "calitateadetinuta", "nrdepartisociale", "valoareatotala", "tipulcontractului", "dataincheierii",
    "duratacontractului", "persoanelecucare", "sevordeclara", "beneficiaruldecontract", "institutiacontractanta", "proceduraprin", "nota",
    "prinrude", "numelepersoanei", "valoareabeneficiului",
)
SENTENCES = ("precum si", "sau alte", "ori ale", "in cadrul exercitarii", "denumirea si adresa", "se vor declara", "obtinute ori aflate")
# A numbered row of the form, and words that name a firm, an association or a party.
NUMBERED = r"^\s*\d{1,2}\.\d{1,2}\b"
ENTITY = (
    r"(?i)(S\.?\s?C\.?\s|\bS\.?\s?R\.?\s?L\.?\b|\bS\.?\s?A\.?\b|\bP\.?\s?F\.?\s?A\.?\b|asocia[tţț]i|funda[tţț]i|\bpartidul\b|\bP\.?N\.?L\b"
    r"|\bP\.?S\.?D\b|\bU\.?S\.?R\b|sindicat|federa[tţț]i|uniune|cooperativ|regia\b|compania\b|\bONG\b)"
)
SHORTEST_TEXT, SHORTEST_LINE, LONGEST_ENTRY, MOST_ENTITIES, ENTITY_WIDTH = 80, 4, 12, 60, 80


def _any(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])


def _lines(text: Column, boilerplate: tuple[str, ...]) -> Column:
    """What the fold asks of each line: opens (a bit for each section), entry, entity (its text or null), amount in bani.

    In steps, each over the array of the one before, so that no line is folded twice."""
    raw = F.split(text, "\r\n|[\n\r\x0B\f\x1C-\x1E\x85\u2028\u2029]")
    lines = F.transform(F.transform(raw, lambda x: F.btrim(x, F.lit(" -•\t|"))), lambda x: F.struct(x.alias("line"), F.lower(strip_accents(x)).alias("folded")))
    bare = lambda x: F.replace(x["folded"], F.lit(" "), F.lit(""))
    # of what the pattern takes for white space, a line holds blanks and tabs only
    odd = lambda x: F.contains(x["folded"], F.lit("  ")) | F.contains(x["folded"], F.lit("\t"))
    spaced = lambda x: F.trim(F.when(odd(x), F.regexp_replace(x["folded"], r"\s+", " ")).otherwise(x["folded"]))
    lines = F.transform(lines, lambda x: F.struct(x["line"].alias("line"), bare(x).alias("bare"), spaced(x).alias("spaced")))
    tight = lambda x: F.replace(x["spaced"], F.lit(" "), F.lit(""))
    lines = F.transform(lines, lambda x: F.struct(x["line"].alias("line"), x["bare"].alias("bare"), x["spaced"].alias("spaced"), tight(x).alias("tight")))

    def kinds(x: Column) -> Column:
        opens = sum((F.when(_any(x["bare"], phrases), 1 << i).otherwise(0) for i, (_, phrases) in enumerate(SECTIONS)), F.lit(0))
        form = (F.length(x["spaced"]) < SHORTEST_LINE) | _any(x["tight"], FORM)
        if boilerplate:
            form = form | x["spaced"].isin(*boilerplate)
        short = F.octet_length(x["spaced"]) - F.octet_length(x["tight"]) < LONGEST_ENTRY  # single blanks, one fewer than words
        return F.struct(x["line"].alias("line"), opens.alias("opens"), form.alias("form"), (short & ~_any(x["spaced"], SENTENCES)).alias("short"))

    def named(x: Column) -> Column:
        entity = x["short"] & ~x["form"] & F.rlike(x["line"], F.lit(ENTITY))
        return F.struct(x["line"].alias("line"), x["opens"].alias("opens"), x["form"].alias("form"), entity.alias("entity"))

    def asked(x: Column) -> Column:
        numbered = ~x["form"] & F.rlike(x["line"], F.lit(NUMBERED))
        amount = F.when(F.rlike(x["line"], F.lit("[0-9]")), F.round(amounts_in(x["line"]) * 100).cast("long")).otherwise(F.lit(0).cast("long"))
        return F.struct(
            x["opens"].alias("opens"),
            (x["entity"] | numbered).cast("int").alias("entry"),
            F.when(x["entity"], F.substring(x["line"], 1, ENTITY_WIDTH)).alias("entity"),
            amount.alias("amount"),
        )

    return F.transform(F.transform(F.transform(lines, kinds), named), asked)


def interests(text: Column, boilerplate: tuple[str, ...] = ()) -> Column:
    """struct(text_extracted, counts, amounts, entities, has_any) of a declaration of interests.

    A section starts at the first line that holds one of its phrases and ends where the next starts; a line that opens
    several belongs to none, and the last of them goes on. Within a section the numbered rows and the short lines
    that name an entity count, but for the lines of the form itself (``FORM``, and whole lines of
    ``boilerplate``). The state of the fold is the set of sections seen, the current one, a count and an amount (lei) for
    each, and the first 60 entities, which are returned distinct and sorted. Null and texts below 80 characters are not
    extracted; a sum is of its lines, so an amount broken over two lines is not read.
    """
    # bound as the one element of an array, because a fold works out again whatever it names from outside
    given = F.transform(F.array(F.coalesce(text, F.lit(""))), lambda x: F.struct(x.alias("text"), (F.length(F.trim(x)) >= SHORTEST_TEXT).alias("enough")))
    return F.transform(given, lambda x: _folded(x["text"], x["enough"], boilerplate))[0]


def _folded(text: Column, enough: Column, boilerplate: tuple[str, ...]) -> Column:
    """``interests`` of a text that is no null; ``enough`` says whether it is long enough."""
    n = len(SECTIONS)
    lines = _lines(text, boilerplate)
    zero = F.struct(
        F.lit(0).alias("seen"),
        F.lit(-1).alias("now"),
        F.array_repeat(F.lit(0), n).alias("counts"),
        F.array_repeat(F.lit(0).cast("long"), n).alias("amounts"),
        F.array().cast("array<string>").alias("entities"),
    )

    def step(state: Column, line: Column) -> Column:
        new = line["opens"].bitwiseAND(F.bitwise_not(state["seen"]))
        last = reduce(lambda a, i: F.when(new >= (1 << i), i).otherwise(a), range(n), F.lit(-1))
        inside = (new == 0) & (state["now"] >= 0)
        here = lambda name, more: F.transform(state[name], lambda x, i: F.when(inside & (i == state["now"]), x + more).otherwise(x))
        named = inside & line["entity"].isNotNull() & (F.size(state["entities"]) < MOST_ENTITIES)
        return F.struct(
            state["seen"].bitwiseOR(new).alias("seen"),
            F.when(new > 0, last).otherwise(state["now"]).alias("now"),
            here("counts", line["entry"]).alias("counts"),
            here("amounts", line["amount"]).alias("amounts"),
            F.when(named, F.array_append(state["entities"], line["entity"])).otherwise(state["entities"]).alias("entities"),
        )

    def finish(state: Column) -> Column:
        counts = F.when(enough, state["counts"]).otherwise(F.array_repeat(F.lit(0), n))
        amounts = F.when(enough, state["amounts"]).otherwise(F.array_repeat(F.lit(0).cast("long"), n))
        return F.struct(
            enough.alias("text_extracted"),
            F.struct(*[counts[i].alias(k) for i, (k, _) in enumerate(SECTIONS)]).alias("counts"),
            F.struct(*[(amounts[i] / 100).alias(k) for i, (k, _) in enumerate(SECTIONS)]).alias("amounts"),
            F.when(enough, F.array_sort(F.array_distinct(state["entities"]))).otherwise(F.array().cast("array<string>")).alias("entities"),
            F.exists(counts, lambda x: x > 0).alias("has_any"),
        )

    return F.aggregate(lines, zero, step, finish)
