"""License scan by sentence rules (DataFrame functions only, no shuffle).

A text is split into sentences, each sentence is normalised, and known ones are mapped to licence
sentence identifiers. The identifiers of a document, in order, form a sequence that is matched
against ordered rules; what a rule matches is used up, so a later, looser rule cannot claim it.

Sentences end at closing marks before white space and at empty lines. Single line breaks join, and comment
marks at the beginning of lines are passed over, so notices are recognised wrapped, commented and on one
line alike. `;` and `:` stay inside. A sentence can have several identifiers, one of each group of
alternatives, in the order of the groups. The line of an SPDX tag is a sentence of its own.

Defined cases: null and empty texts have no sentences and no licences. Repeated rows are judged
alike and all returned. Identifiers that no rule uses up are reported as unmatched. Extra columns are
ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import ascii_lower

# What begins a line but is no part of its text: blanks and comment marks.
LINE_BEGIN = r"\n[ \t\r]*[#*;%/|-]*[ \t\r]*"
# Where a sentence ends: closing marks before white space or the end, or an empty line.
SENTENCE_END = r"[.!?]+(?:[\x20\x09-\x0D]+|$)|\n\n+"
SPDX_TAG = "SPDX-License-Identifier:"
# Only sentences with one of these words can be known ones.
HINT = r"licen[cs]e|permission|warrant|redistribut|public domain|free software|copyright|misrepresented"

FREE = r"free software you (?:can|may) redistribute it and/or modify it under the terms of the gnu "
LESSER, AFFERO = "(?:lesser|library) ", "affero "


def _free(kind: str, version: str, later: bool) -> str:
    """The grant of a GNU licence in one sentence, up to its version."""
    end = " of the license or .*any later version" if later else r" of the license(?: |$)"
    return f"{FREE}{kind}general public license .*version {version}{end}"


# Names of licences in SPDX tags.
SPDX = """MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC Zlib MPL-2.0 EPL-1.0 EPL-2.0 BSL-1.0 CC0-1.0 Unlicense
GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only
LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later""".split()

# Known sentences: groups of alternatives, each an identifier and a pattern over the normalised sentence.
SENTENCES = [
    *[
        [(f"spdx:{name}", rf"spdx-license-identifier (?:.* )?{re.escape(name.lower())}(?: |$)")]
        for name in SPDX
    ],
    [("apache2", r"licensed under the apache license version 2(?:\.0)?(?: |$)")],
    [
        ("agpl3Later", _free(AFFERO, "3", True)),
        ("agpl3", _free(AFFERO, "3", False)),
        ("lgpl3Later", _free(LESSER, "3", True)),
        ("lgpl21Later", _free(LESSER, r"2\.1", True)),
        ("lgpl3", _free(LESSER, "3", False)),
        ("lgpl21", _free(LESSER, r"2\.1", False)),
        ("gpl3Later", _free("", "3", True)),
        ("gpl2Later", _free("", "2", True)),
        ("gpl3Only", _free("", "3", False)),
        ("gpl2Only", _free("", "2", False)),
        ("gplFree", f"{FREE}general public license"),
    ],
    [
        ("gpl3", r"licensed under the (?:gnu general public license|gpl)(?: version)? ?v?3(?:\.0)?(?: |$)"),
        ("gpl2", r"licensed under the (?:gnu general public license|gpl)(?: version)? ?v?2(?:\.0)?(?: |$)"),
        ("gplNoVersion", r"licensed under the (?:gnu general public license|gpl)$"),
    ],
    [
        ("ccByNc4", r"licensed under (?:a )?(?:cc|creative commons) by-nc 4\.0"),
        ("ccBySa4", r"licensed under (?:a )?(?:cc|creative commons) by-sa 4\.0"),
        ("ccBy4", r"licensed under (?:a )?(?:cc|creative commons) by 4\.0"),
    ],
    [("mitName", r"(?:licensed|released|distributed) under the (?:terms of the )?mit license(?: |$)")],
    [("bsd3Name", r"(?:licensed|released|distributed) under the bsd 3-clause license(?: |$)")],
    [("boostName", r"distributed under the boost software license version 1\.0(?: |$)")],
    [("mpl2", r"subject to the terms of the mozilla public license v(?: |$)")],
    [
        ("epl2", r"terms of the eclipse public license (?:version |v ?\.? ?)?2(?:\.0)?(?: |$)"),
        ("epl1", r"terms of the eclipse public license (?:version |v ?\.? ?)?1(?:\.0)?(?: |$)"),
    ],
    [
        ("mitPermission", r"permission is hereby granted free of charge to any person obtaining a copy"),
        ("boostPermission", r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
        ("iscPermission", r"permission to use copy modify and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
        ("zlibPermission", r"permission is granted to anyone to use this software for any purpose"),
    ],
    [("mitNotice", r"copyright notice and this permission notice shall be included")],
    [("bsdRedistribution", r"redistribution and use in source and binary forms")],
    [("bsdSource", r"redistributions of source code must retain the above copyright notice")],
    [("bsdBinary", r"redistributions in binary form must reproduce the above copyright notice")],
    [("bsdEndorse", r"endorse or promote products derived from this software without .*permission")],
    [
        ("unlicense", r"this is free and unencumbered software released into the public domain"),
        ("publicDomain", r"(?:released into|is in) the public domain$"),
    ],
    [("cc0", r"waived all copyright and related or neighboring rights")],
    [("zlibOrigin", r"the origin of this software must not be misrepresented")],
    [
        ("zlibAsIs", r"provided as-is without any express or implied warranty"),
        ("asIs", r"(?:provided|distributed) .*as is.*(?:without warrant|implied warrant|disclaims all warrant)"),
        ("noWarranty", r"without any warranty"),
    ],
    [("gplDetails", r"see the gnu .*general public license for more details")],
    [("gplCopy", r"should have received a copy of the gnu .*general public license")],
    [("seeLicense", r"see the license (?:file )?for")],
    [("allRights", r"copyright .*all rights reserved$")],
]

GNU_REST = "(?:noWarranty,)?(?:gplDetails,)?(?:gplCopy,)?"
# Ordered rules: licence and pattern over the sequence, in which each identifier ends in a comma.
RULES = [
    ("BSD-3-Clause", r"bsdRedistribution,bsdSource,bsdBinary,bsdEndorse,(?:asIs,)?"),
    ("BSD-2-Clause", r"bsdRedistribution,bsdSource,bsdBinary,(?:asIs,)?"),
    ("MIT", r"mitPermission,mitNotice,(?:asIs,)?"),
    ("ISC", r"iscPermission,(?:asIs,)?"),
    ("Zlib", r"(?:zlibAsIs,)?zlibPermission,(?:zlibOrigin,)?"),
    ("Unlicense", r"unlicense,"),
    ("BSL-1.0", r"boostPermission,(?:asIs,)?|boostName,"),
    ("AGPL-3.0-or-later", f"agpl3Later,{GNU_REST}"),
    ("AGPL-3.0-only", f"agpl3,{GNU_REST}"),
    ("LGPL-3.0-or-later", f"lgpl3Later,{GNU_REST}"),
    ("LGPL-2.1-or-later", f"lgpl21Later,{GNU_REST}"),
    ("LGPL-3.0-only", f"lgpl3,{GNU_REST}"),
    ("LGPL-2.1-only", f"lgpl21,{GNU_REST}"),
    ("GPL-3.0-or-later", f"gpl3Later,{GNU_REST}"),
    ("GPL-2.0-or-later", f"gpl2Later,{GNU_REST}"),
    ("GPL-3.0-only", f"gpl3Only,{GNU_REST}"),
    ("GPL-2.0-only", f"gpl2Only,{GNU_REST}"),
    ("Apache-2.0", r"apache2,(?:asIs,)?(?:seeLicense,)?"),
    ("GPL-3.0", f"gpl3,{GNU_REST}"),
    ("GPL-2.0", f"gpl2,{GNU_REST}"),
    ("GPL", f"(?:gplNoVersion|gplFree),{GNU_REST}"),
    ("CC-BY-NC-4.0", r"ccByNc4,"),
    ("CC-BY-SA-4.0", r"ccBySa4,"),
    ("CC-BY-4.0", r"ccBy4,"),
    ("CC0-1.0", r"cc0,"),
    ("MPL-2.0", r"mpl2,"),
    ("EPL-2.0", r"epl2,"),
    ("EPL-1.0", r"epl1,"),
    ("MIT", r"mitName,|mitPermission,"),
    ("BSD-3-Clause", r"bsd3Name,"),
    ("Public-Domain", r"publicDomain,"),
    *[(name, f"spdx:{re.escape(name)},") for name in SPDX],
]


def unwrapped(text: Column) -> Column:
    """The text with bare lines, each after one line break, and an empty line behind an SPDX tag."""
    bare = F.regexp_replace(F.concat(F.lit("\n"), text), LINE_BEGIN, "\n")
    tagged = F.regexp_replace(bare, f"({SPDX_TAG}[^\n]*)", "$1\n\n")
    return F.when(text.contains(SPDX_TAG), tagged).otherwise(bare)


def normalised(sentence: Column) -> Column:
    """Lower-case words of letters, digits and '.+-/', parted by single spaces."""
    return F.trim(F.regexp_replace(ascii_lower(sentence), r"[^a-z0-9.+/-]+", " "))


def identifiers(sentence: Column) -> Column:
    """What a normalised sentence is known as: of each group the first that fits."""

    def first(group: list[tuple[str, str]]) -> Column:
        return F.coalesce(*[F.when(sentence.rlike(f"(^| ){pattern}"), F.lit(name)) for name, pattern in group])

    return F.array_compact(F.array(*[first(group) for group in SENTENCES]))


def match_rules(sequence: Column) -> tuple[Column, Column]:
    """Licences found in a sequence text, in rule order, and what is left of the sequence."""
    found, left = [], sequence
    for name, pattern in RULES:
        whole = f"(?:^|,)(?:{pattern})"
        # used-up identifiers leave one comma, so their neighbours cannot be taken for a sequence
        found.append(F.when(left.rlike(whole), F.lit(name)))
        left = F.regexp_replace(left, whole, ",")
    return F.array_distinct(F.array_compact(F.array(*found))), left


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_sentences, sentence_ids, licenses and unmatched (arrays)."""
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    pieces = rows.select("id", F.split(unwrapped(F.col("text")), SENTENCE_END).alias("sentences"))
    hinted = F.filter("sentences", lambda s: s.rlike(f"(?i){HINT}"))
    clean = pieces.select(
        "id",
        F.size(F.filter("sentences", lambda s: F.trim(s, F.lit(" \n")) != "")).cast("bigint").alias("n_sentences"),
        F.transform(hinted, normalised).alias("hinted"),
    )
    ids = clean.withColumn("sentence_ids", F.flatten(F.transform("hinted", identifiers)))
    # every identifier ends in a comma and follows one
    sequence = F.concat(F.lit(","), F.array_join(F.transform("sentence_ids", lambda x: F.concat(x, F.lit(","))), ""))
    licenses, left = match_rules(F.col("sequence"))
    return ids.withColumn("sequence", sequence).select(
        F.col("id").alias(doc_id),
        "n_sentences",
        "sentence_ids",
        licenses.alias("licenses"),
        F.filter(F.split(left, ","), lambda x: x != "").alias("unmatched"),
    )
