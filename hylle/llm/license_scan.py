"""Licences by sentence recognition and ordered rules.

A text is cut into sentences (a full stop, question or exclamation mark and blanks
end one), a sentence into lines, which are normalised (lower case, only letters and
digits, single blanks, one spelling of licence); lines without any are left out. Every
run of lines that is no longer than the longest known licence sentence and starts with
the first word of one is looked up among them, so a sentence is found whether it is
wrapped or stands beside other lines, at any width. From the first line on, the longest
known sentence takes its lines, and the next one starts behind them. What remains of a document is the
sequence of the identifiers found, in order of place. Rules are tried in order on
that sequence; a rule takes the identifiers it matches, so a longer licence is not
reported again as the shorter one it contains.

The known sentences are a fixed table of a few hundred rows that is broadcast. Each
holds one of ``KEYWORDS``; texts and sentences without any are not cut further.
Only hits are shuffled, and they are few per document.

Defined cases: null and empty texts and texts without a known sentence give no row;
identifiers that no rule takes are counted as unmatched; a repeated sentence gives
its identifier each time, its licence once; repeated rows give one result each;
of runs at one place the longest known one counts, and none that starts inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hylle.llm.common import KEY, row_key, staged

# Lines that the query's SQL joins at most; nothing here is bounded by it.
WRAP = 12
END = "\x01"

# Licence names as they stand in notices, by identifier.
NAMES = {
    "MIT": ("mit license", "mit"),
    "Apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0"),
    "GPL-2.0": ("gnu general public license version 2", "gnu gpl version 2", "gnu gpl v2", "gpl 2 0", "gplv2"),
    "GPL-3.0": ("gnu general public license version 3", "gnu gpl version 3", "gnu gpl v3", "gpl 3 0", "gplv3"),
    "LGPL-2.1": ("gnu lesser general public license version 2 1", "lgpl 2 1"),
    "LGPL-3.0": ("gnu lesser general public license version 3", "lgpl 3 0"),
    "AGPL-3.0": ("gnu affero general public license version 3", "agpl 3 0"),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license v 2 0", "mpl 2 0"),
    "BSD-2-Clause": ("bsd 2 clause license", "simplified bsd license", "bsd 2 clause"),
    "BSD-3-Clause": ("bsd 3 clause license", "new bsd license", "bsd 3 clause"),
    "ISC": ("isc license", "isc"),
    "CC0-1.0": ("cc0 1 0", "creative commons zero v1 0 universal"),
    "CC-BY-4.0": ("cc by 4 0", "creative commons attribution 4 0 international license"),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"),
    "CC-BY-ND-4.0": ("cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"),
}
# How a notice names its licence; "{}" is the name.
NOTICES = (
    "licensed under {}",
    "released under {}",
    "distributed under {}",
    "license {}",
    "this work is licensed under {}",
    "this file is licensed under {}",
    "this software is released under {}",
    "this project is licensed under {}",
)
# Sentences of licence texts, normalised, by identifier.
SENTENCES = {
    "reserved": "all rights reserved",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-grant-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "bsd-conditions": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-warranty": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "apache-license": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-unless": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl2-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl3-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "mpl-terms": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "unlicense-domain": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
}
# Single words or their stems; every known sentence has one.
KEYWORDS = (
    "licen", "reserved", "copyright", "permission", "warrant", "distribut", "liab", "released", "encumbered", "anyone", "mpl",
)
# Rules in the order in which they are tried, as runs of identifiers;
# one in brackets may be missing.
RULES = (
    ("MIT", "mit-grant mit-notice mit-warranty [mit-liability]"),
    ("MIT", "mit-grant-notice mit-warranty [mit-liability]"),
    ("ISC", "isc-grant [isc-warranty]"),
    ("BSD-3-Clause", "bsd-conditions bsd-source bsd-binary bsd-endorse [bsd-warranty]"),
    ("BSD-2-Clause", "bsd-conditions bsd-source bsd-binary [bsd-warranty]"),
    ("Apache-2.0", "apache-license [apache-copy] [apache-unless] [apache-see]"),
    ("GPL-2.0-or-later", "gpl2-later [gpl-hope] [gpl-see]"),
    ("GPL-3.0-or-later", "gpl3-later [gpl-hope] [gpl-see]"),
    ("MPL-2.0", "mpl-terms [mpl-copy]"),
    ("Unlicense", "unlicense-domain [unlicense-anyone]"),
    *((name, f"notice:{name}") for name in NAMES),
    ("All-rights-reserved", "reserved"),
)


def known_sentences() -> dict[str, str]:
    """Normalised sentence to identifier."""
    found = {text: name for name, text in SENTENCES.items()}
    for name, variants in NAMES.items():
        for variant in variants:
            for notice in NOTICES:
                for article in ("", "the "):
                    found[notice.format(article + variant)] = f"notice:{name}"
        found[f"spdx license identifier {name.lower().replace('-', ' ').replace('.', ' ')}"] = f"notice:{name}"
    return found


def rule_patterns() -> list[tuple[str, str]]:
    """Each rule's licence and its pattern over a text of identifiers, each in < and >."""
    out = []
    for name, rule in RULES:
        steps = (f"(?:<{s[1:-1]}>)?" if s[0] == "[" else f"<{s}>" for s in rule.split())
        out.append((name, "".join(steps).replace(".", r"\.")))
    return out


def _any_keyword(text: Column) -> Column:
    found = F.contains(text, F.lit(KEYWORDS[0]))
    for word in KEYWORDS[1:]:
        found = found | F.contains(text, F.lit(word))
    return found


def normalised(text: Column) -> Column:
    plain = F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.regexp_replace(plain, "licence", "license")


def recognised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row key, sentence, first line (of those with words) and identifier of each known sentence."""
    spark = docs.sparkSession
    sentences = sorted(known_sentences().items())
    known = spark.createDataFrame(sentences, "plain string, sentence_id string")
    longest = max(len(plain) for plain, _ in sentences)
    first_words = sorted({plain.split(" ")[0] for plain, _ in sentences})
    sentence = F.split(F.regexp_replace("_text", r"([.!?])\s+", "$1" + END), END)
    # n lines have 2 n - 1 characters at least, so no run of more lines can be known
    runs = F.expr(
        f"aggregate(slice(lines, line + 1, {longest // 2 + 1}),"
        " named_struct('run', '', 'runs', cast(array() AS array<string>)),"
        f" (s, l) -> if(s.run IS NULL OR length(s.run) + 1 + length(l) > {longest + 1},"
        " named_struct('run', cast(NULL AS string), 'runs', s.runs),"
        " named_struct('run', concat(s.run, ' ', l), 'runs', array_append(s.runs, substr(concat(s.run, ' ', l), 2)))),"
        " s -> s.runs)"
    )
    # from the first line on, the longest takes its lines
    taken = F.expr(
        "aggregate(hits, named_struct('end', 0, 'kept', cast(array() AS array<struct<line:int,sentence_id:string>>)),"
        " (s, h) -> if(h.line < s.end, s, named_struct('end', h.line - h.less + 1,"
        " 'kept', array_append(s.kept, named_struct('line', h.line, 'sentence_id', h.sentence_id)))),"
        " s -> s.kept)"
    )
    return (
        docs.select(*(c.alias(k) for k, c in row_key(id_col, text_col).items()), F.col(text_col).alias("_text"))
        .where(_any_keyword(F.lower("_text")))
        .select(*KEY, F.posexplode(sentence).alias("at", "one"))
        .where(_any_keyword(F.lower("one")))
        .select(*KEY, "at", F.filter(F.transform(F.split("one", "\n"), normalised), lambda l: l != "").alias("lines"))
        .select(*KEY, "at", "lines", F.posexplode("lines").alias("line", "start"))
        .where(F.substring_index("start", " ", 1).isin(first_words))
        .select(*KEY, "at", "line", F.posexplode(runs).alias("more", "plain"))
        .where(_any_keyword(F.col("plain")))
        .join(F.broadcast(known), "plain")
        .distinct()  # repeated rows
        .groupBy(*KEY, "at")
        .agg(F.sort_array(F.collect_list(F.struct("line", (-F.col("more")).alias("less"), "sentence_id"))).alias("hits"))
        .select(*KEY, "at", F.inline(taken))
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with a known sentence: row key, ``sentence_ids``, ``licenses``, ``n_unmatched``."""
    found = (
        recognised(docs, id_col, text_col)
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_list(F.struct("at", "line", "sentence_id"))).alias("_found"))
        .select(*KEY, F.transform("_found", lambda x: x["sentence_id"]).alias("_ids"))
        .select(*KEY, "_ids", F.concat(F.lit("<"), F.array_join("_ids", "><"), F.lit(">")).alias("_left"))
    )
    taken = []
    for n, (name, pattern) in enumerate(rule_patterns()):
        found = found.withColumns(
            {
                f"_r{n}": F.when(F.col("_left").rlike(pattern), F.lit(name)),
                "_left": F.regexp_replace("_left", pattern, "|"),
            }
        )
        taken.append(F.col(f"_r{n}"))
    return found.select(
        *KEY,
        F.array_join("_ids", ",").alias("sentence_ids"),
        F.array_join(F.array_distinct(F.array_compact(F.array(*taken))), ",").alias("licenses"),
        F.regexp_count("_left", F.lit("<")).cast("long").alias("n_unmatched"),
    )


def with_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and findings of each row with a known sentence."""
    found = staged(scan(docs, id_col, text_col), "licenses")
    rows = docs.select(id_col, *(c.alias(k) for k, c in row_key(id_col, text_col).items()))
    return rows.join(found, list(KEY)).drop(*KEY)
