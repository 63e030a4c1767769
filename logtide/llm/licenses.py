"""License scans by sentence rules.

A text is cut into sentences; a sentence is normalised and recognised by the first sentence
pattern it matches, which gives an identifier. Each line is a sentence, as headings are; where a
sentence is wrapped over lines, what only its joined lines show takes the place of the parts that
its lines showed. The identifiers in their order form a sequence,
and ordered rules over such sequences name the licences: what a rule has matched is used up,
so a full grant is not read again as the shorter notice it contains.

Both tables are plain values, compiled into built-in expressions; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.common import BLANKS

# (identifier, pattern on the normalised sentence): lower case, letters, digits, dots inside
# numbers, hyphens and single spaces only. The first match counts.
SENTENCES = (
    ("ApacheGrant", r"licensed under the apache license,? version 2(\.0)?"),
    ("ApacheGrant", r"apache license,? version 2(\.0)?|apache-2\.0|apache 2\.0 license"),
    ("ApacheOther", r"apache (software )?license"),
    ("LesserGpl3", r"(lesser|library) (gnu )?general public license,? (as published .*)?(version|v) ?3|lgpl-?3|lgpl-3\.0"),
    ("LesserGpl2", r"(lesser|library) (gnu )?general public license,? (as published .*)?(version|v) ?2|lgpl-?2"),
    ("Affero3", r"affero general public license|agpl-?3"),
    ("Gpl3OrLater", r"gnu general public license.* version 3.* any later version"),
    ("Gpl2OrLater", r"gnu general public license.* version 2.* any later version"),
    ("Gpl3", r"gnu general public license,? (as published .* )?(version|v) ?3|gplv3|gpl-3\.0|gpl version 3"),
    ("Gpl2", r"gnu general public license,? (as published .* )?(version|v) ?2|gplv2|gpl-2\.0|gpl version 2"),
    ("GplAny", r"gnu general public license"),
    ("OrLater", r"^(or )?\(?at your option\)? any later version"),
    ("MitGrant", r"(released|licensed|distributed|available) under the mit license"),
    ("MitName", r"^(the )?mit license$|spdx.*\bmit\b"),
    ("MitPermission", r"permission is hereby granted,? free of charge,? to any person obtaining a copy"),
    ("NoticeShallBeIncluded", r"copyright notice and this permission notice shall be included"),
    ("BsdRedistribution", r"redistribution and use in source and binary forms"),
    ("BsdRetainSource", r"redistributions of source code must retain"),
    ("BsdRetainBinary", r"redistributions in binary form must reproduce"),
    ("BsdNoEndorsement", r"neither the name of .* may be used to endorse"),
    ("AsIs", r"software is provided .*as is|as is,? without warranty"),
    ("CcByNcSa4", r"(cc|creative commons) ?-?(by-nc-sa|attribution-noncommercial-sharealike) ?-?4\.0"),
    ("CcByNc4", r"(cc|creative commons) ?-?(by-nc|attribution-noncommercial) ?-?(4\.0|4)"),
    ("CcBySa4", r"(cc|creative commons) ?-?(by-sa|attribution-sharealike) ?-?4\.0"),
    ("CcBy4", r"(cc|creative commons) ?-?(by|attribution) ?-?4\.0"),
    ("Cc0", r"\bcc0\b|creative commons zero"),
    ("Mpl2", r"mozilla public license,? (v\. ?|version )?2|mpl-2\.0"),
    ("AllRightsReserved", r"all rights reserved"),
    ("UnknownGrant", r"(licensed|released|distributed) under (the )?[a-z0-9 .-]{2,60}licen[sc]e"),
)


@dataclass(frozen=True)
class LicenseRule:
    """``sequence``: identifiers in order, each followed by a space; a regular expression."""

    name: str
    sequence: str


# Longest evidence first: a rule sees only what the rules above it have left.
RULES = (
    LicenseRule("BSD-3-Clause", "BsdRedistribution (BsdRetainSource )?(BsdRetainBinary )?BsdNoEndorsement (AsIs )?"),
    LicenseRule("BSD-2-Clause", "BsdRedistribution (BsdRetainSource )?(BsdRetainBinary )?(AsIs )?"),
    LicenseRule("MIT", "(MitName )?MitPermission (NoticeShallBeIncluded )?(AsIs )?"),
    LicenseRule("MIT", "MitGrant |MitName "),
    LicenseRule("GPL-3.0-or-later", "Gpl3OrLater |Gpl3 OrLater "),
    LicenseRule("GPL-2.0-or-later", "Gpl2OrLater |Gpl2 OrLater "),
    LicenseRule("LGPL-3.0", "LesserGpl3 "),
    LicenseRule("LGPL-2.0", "LesserGpl2 "),
    LicenseRule("AGPL-3.0", "Affero3 "),
    LicenseRule("GPL-3.0", "Gpl3 "),
    LicenseRule("GPL-2.0", "Gpl2 "),
    LicenseRule("GPL", "GplAny "),
    LicenseRule("Apache-2.0", "ApacheGrant "),
    LicenseRule("Apache", "ApacheOther "),
    LicenseRule("CC-BY-NC-SA-4.0", "CcByNcSa4 "),
    LicenseRule("CC-BY-NC-4.0", "CcByNc4 "),
    LicenseRule("CC-BY-SA-4.0", "CcBySa4 "),
    LicenseRule("CC-BY-4.0", "CcBy4 "),
    LicenseRule("CC0-1.0", "Cc0 "),
    LicenseRule("MPL-2.0", "Mpl2 "),
    LicenseRule("Proprietary", "AllRightsReserved "),
    LicenseRule("Unknown", "UnknownGrant "),
)

# A text without any of these words holds no sentence of the table.
HINT = r"(?i)licen[sc]|gpl|permission|redistribution|copyright|warranty|creative commons|\bcc|apache|rights reserved|later version|neither the name|spdx|mpl-2"
# The same on text whose lines may be wrapped anywhere.
WRAPPED_HINT = HINT.replace(" ", "[^A-Za-z0-9.(),-]+")
# A wrapped sentence ends at a blank line, or at a mark that white space follows.
ENDS = r"\n[\x20\x09-\x0D]*\n|[.!?](?=[\x20\x09-\x0D])"

# What a wider identifier says already. A grant of any known licence is no unknown one.
PARTS = {name: {"UnknownGrant"} for name, _ in SENTENCES if name != "UnknownGrant"}
PARTS["Gpl3OrLater"] |= {"Gpl3", "GplAny", "OrLater"}
PARTS["Gpl2OrLater"] |= {"Gpl2", "GplAny", "OrLater"}
PARTS["ApacheGrant"] |= {"ApacheOther"}
PARTS["MitGrant"] |= {"MitName"}
for _name in ("Gpl3", "Gpl2"):
    PARTS[_name] |= {"GplAny"}
for _name in ("LesserGpl3", "LesserGpl2", "Affero3"):
    PARTS[_name] |= {"GplAny", "OrLater"}
LINES_ONLY = frozenset({"MitName", "OrLater"})


def _plain(s: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(s), r"[^a-z0-9.(),-]+", " "), r"[.(), -]+$", ""))


def _identified(sentence: Column) -> Column:
    first, *others = SENTENCES
    found = F.when(sentence.rlike(first[1]), first[0])
    for name, pattern in others:
        found = found.when(sentence.rlike(pattern), name)
    return found


def _of_lines(sentence: Column) -> Column:
    """Identifiers of the lines of a sentence, each on its own."""
    plain = F.filter(F.transform(F.split(sentence, "\n"), _plain), lambda s: s.rlike(HINT))
    return F.filter(F.transform(plain, _identified), lambda i: i.isNotNull())


def _of_wrapped(joined: Column, lines: Column) -> Column:
    """Identifiers of a sentence from its joined lines and those of its ``lines``."""
    names = dict.fromkeys(name for name, _ in SENTENCES)
    patterns = {n: "|".join(f"(?:{p})" for name, p in SENTENCES if name == n) for n in names}
    table = F.array(
        *[
            F.struct(
                F.lit(n).alias("id"),
                F.lit(p).alias("pattern"),
                F.lit(n in LINES_ONLY).alias("lines_only"),
                F.array(*[F.lit(w) for w in names if n in PARTS.get(w, ())]).cast("array<string>").alias("wider"),
            )
            for n, p in patterns.items()
        ]
    )

    def of(found: Column) -> Column:
        ids = F.transform(found, lambda r: r["id"])
        fresh = F.filter(
            found, lambda r: ~r["lines_only"] & ~F.array_contains(lines, r["id"]) & ~F.arrays_overlap(r["wider"], ids)
        )
        fresh_ids = F.transform(fresh, lambda r: r["id"])
        wider = F.create_map(*[x for n in names for x in (F.lit(n), F.array(*[F.lit(w) for w in names if n in PARTS.get(w, ())]).cast("array<string>"))])
        left = F.filter(lines, lambda i: ~F.arrays_overlap(wider[i], fresh_ids))
        places = F.create_map(*[x for n, p in patterns.items() for x in (F.lit(n), F.lit(p.replace("^", "").replace("$", "")))])
        placed = F.transform(
            F.concat(left, fresh_ids),
            lambda i, k: F.struct(F.call_function("regexp_instr", joined, places[i]).alias("at"), k.alias("k"), i.alias("i")),
        )
        return F.when(F.size(fresh) > 0, F.transform(F.array_sort(placed), lambda x: x["i"])).otherwise(lines)

    # A lambda over one element evaluates the matches of the table once.
    found = F.filter(table, lambda r: F.call_function("rlike", joined, r["pattern"]))
    return F.when(joined.rlike(HINT), F.flatten(F.transform(F.array(found), of))).otherwise(lines)


def identifiers(text: Column) -> Column:
    """Identifiers of the sentences of a text, in order."""

    def of(sentence: Column) -> Column:
        both = F.array(F.struct(_plain(sentence).alias("joined"), _of_lines(sentence).alias("lines")))
        wrapped = F.flatten(F.transform(both, lambda x: _of_wrapped(x["joined"], x["lines"])))
        return F.when(F.trim(sentence, F.lit(BLANKS)).contains("\n"), wrapped).otherwise(_of_lines(sentence))

    return F.flatten(F.transform(F.split(text, ENDS), of))


def license_scan(docs: DataFrame) -> DataFrame:
    """Licences of each row of ``docs`` (doc_id, text): doc_id, n_sentences (recognised ones),
    sentence_ids (in order, joined by blanks), licenses (sorted names, comma-joined, each once).

    Null text and text without a known sentence: none, empty strings. Null ids and repeated
    rows stay; other columns are not read; no rows give no rows.
    """
    text = F.coalesce("text", F.lit(""))
    none = F.expr("cast(array() as array<string>)")
    rows = docs.select("doc_id", F.when(text.rlike(WRAPPED_HINT), identifiers(text)).otherwise(none).alias("ids"))
    rows = rows.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", " ").alias("sentence_ids"))
    # Each rule takes its matches out of the sequence; a bar keeps what is left apart.
    state = F.struct(F.concat("sentence_ids", F.lit(" ")).alias("left"), none.alias("names"))
    table = F.array(*[F.struct(F.lit(r.name).alias("name"), F.lit(f"\\b({r.sequence})").alias("sequence")) for r in RULES])
    named = F.aggregate(
        table,
        state,
        lambda acc, r: F.struct(
            F.regexp_replace(acc["left"], r["sequence"], F.lit("| ")).alias("left"),
            F.when(F.call_function("rlike", acc["left"], r["sequence"]), F.concat(acc["names"], F.array(r["name"])))
            .otherwise(acc["names"])
            .alias("names"),
        ),
        lambda acc: F.array_join(F.array_sort(F.array_distinct(acc["names"])), ","),
    )
    return rows.select(
        "doc_id", "n_sentences", "sentence_ids", F.when(F.col("n_sentences") > 0, named).otherwise("").alias("licenses")
    )
