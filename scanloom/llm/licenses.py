"""Licence scans: known sentences in the text, then ordered rules over their identifiers.

Texts are cut into sentences in three ways: line by line, across the lines of a
paragraph (licence texts are often wrapped), and as notices: without the signs of comments,
SPDX tags whole, no cut after "v." and none between "at" and an address below.  A sentence is normalised to lower-case
ASCII letters and digits with single spaces and looked up among the known ones; a rule
is a sequence of identifiers that must occur in this order, others may stand between.
Everything is a column expression on one row; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import text_of

#: Normalised sentences of published licences; the identifier is the place, from 1.
SENTENCES = [
    "licensed under the apache license version 2 0",
    "licensed under the apache license version 2 0 the license",
    "you may not use this file except in compliance with the license",
    "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "see the license for the specific language governing permissions and limitations under the license",
    "released under the mit license",
    "licensed under the mit license",
    "mit license",
    "the mit license mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "this work is licensed under the gnu general public license version 3",
    "this work is licensed under the gnu general public license version 2",
    "this program is free software",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "either version 3 of the license or at your option any later version",
    "either version 2 of the license or at your option any later version",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "either version 2 1 of the license or at your option any later version",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "this source code form is subject to the terms of the mozilla public license v 2 0",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "this is free and unencumbered software released into the public domain",
    "licensed under cc by 4 0",
    "licensed under cc by sa 4 0",
    "licensed under cc by nc 4 0",
    "licensed under cc by nd 4 0",
    "licensed under cc by nc sa 4 0",
    "licensed under cc by nc nd 4 0",
    "this work is licensed under a creative commons attribution 4 0 international license",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "spdx license identifier mit",
    "spdx license identifier apache 2 0",
    "spdx license identifier gpl 3 0 or later",
    "spdx license identifier bsd 3 clause",
    "all rights reserved",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "this library is free software",
    "you may obtain a copy of the license at https www apache org licenses license 2 0",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
]

#: Ordered rules: (licence, class, identifiers in order).  A rule is left out where an
#: earlier one that holds has all its identifiers.
RULES = [
    ("Apache-2.0", "permissive", (2, 3, 4, 5, 6)),
    ("Apache-2.0", "permissive", (2, 3)),
    ("Apache-2.0", "permissive", (1,)),
    ("Apache-2.0", "permissive", (40,)),
    ("MIT", "permissive", (11, 12)),
    ("MIT", "permissive", (11,)),
    ("MIT", "permissive", (7,)),
    ("MIT", "permissive", (8,)),
    ("MIT", "permissive", (9,)),
    ("MIT", "permissive", (10,)),
    ("MIT", "permissive", (39,)),
    ("GPL-3.0-or-later", "copyleft", (15, 16, 17)),
    ("GPL-2.0-or-later", "copyleft", (15, 16, 18)),
    ("LGPL-3.0-or-later", "copyleft", (15, 19, 17)),
    ("LGPL-2.1-or-later", "copyleft", (15, 19, 20)),
    ("AGPL-3.0-or-later", "copyleft", (15, 21, 17)),
    ("GPL-3.0", "copyleft", (13,)),
    ("GPL-2.0", "copyleft", (14,)),
    ("GPL-3.0-or-later", "copyleft", (41,)),
    ("BSD-3-Clause", "permissive", (22, 23, 24, 25)),
    ("BSD-2-Clause", "permissive", (22, 23, 24)),
    ("BSD-3-Clause", "permissive", (42,)),
    ("MPL-2.0", "copyleft", (26, 27)),
    ("MPL-2.0", "copyleft", (26,)),
    ("ISC", "permissive", (28,)),
    ("Unlicense", "permissive", (29,)),
    ("CC-BY-4.0", "permissive", (30,)),
    ("CC-BY-SA-4.0", "copyleft", (31,)),
    ("CC-BY-NC-4.0", "non-commercial", (32,)),
    ("CC-BY-ND-4.0", "no-derivatives", (33,)),
    ("CC-BY-NC-SA-4.0", "non-commercial", (34,)),
    ("CC-BY-NC-ND-4.0", "non-commercial", (35,)),
    ("CC-BY-4.0", "permissive", (36,)),
    ("CC-BY-SA-4.0", "copyleft", (37,)),
    ("CC-BY-NC-4.0", "non-commercial", (38,)),
    ("GPL-3.0-or-later", "copyleft", (15, 44)),
    ("GPL-2.0-or-later", "copyleft", (15, 45)),
    ("LGPL-3.0-or-later", "copyleft", (15, 46)),
    ("LGPL-2.1-or-later", "copyleft", (15, 47)),
    ("AGPL-3.0-or-later", "copyleft", (15, 48)),
    ("LGPL-3.0-or-later", "copyleft", (49, 19, 17)),
    ("LGPL-2.1-or-later", "copyleft", (49, 19, 20)),
    ("LGPL-3.0-or-later", "copyleft", (49, 46)),
    ("LGPL-2.1-or-later", "copyleft", (49, 47)),
    ("Apache-2.0", "permissive", (2, 3, 50, 5, 6)),
    ("MPL-2.0", "copyleft", (26, 51)),
    ("ISC", "permissive", (52,)),
]
#: Sentences and rules that the SQL text has; it has only the first two cuts.
IN_SQL = (43, 35)


def identifiers(text: Column, wrapped: bool) -> Column:
    """Identifiers of the known sentences of a text, in order, as "<7><12>"."""
    if wrapped:
        marked = F.regexp_replace(text, r"([.!?;:])\s+|\n\s*\n", "$1\x01")
    else:
        marked = F.regexp_replace(F.regexp_replace(text, r"([.!?;:])\s+", "$1\x01"), r"\n", "\x01")
    return _found(marked)


def notices(text: Column) -> Column:
    """As ``identifiers``, of the text cut as notices."""
    bare = F.regexp_replace(text, r"(?m)^[ \t]*(?:/\*+|//+|#+|\*+(?!\w)|;+|--+|%+)", "")
    tags = F.regexp_replace(bare, r"(?i)(SPDX-License-Identifier:[^\n]*)", "\x01$1\x01")
    marked = F.regexp_replace(tags, r"(?i)(?<!\bv)(?<!SPDX-License-Identifier)([.!?;:])\s+|\n\s*\n(?!\s*https?://)", "$1\x01")
    return _found(marked)


def _found(marked: Column) -> Column:
    known = F.array(*map(F.lit, SENTENCES))
    place = lambda s: F.array_position(known, F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))
    found = F.filter(F.transform(F.split(marked, "\x01"), place), lambda i: i > 0)
    return F.array_join(F.transform(found, lambda i: F.concat(F.lit("<"), i.cast("string"), F.lit(">"))), "")


def _pattern(ids) -> str:
    return "%" + "%".join(f"<{i}>" for i in ids) + "%"


def _absorbed(k: int) -> list[int]:
    """Earlier rules that have all identifiers of rule ``k``."""
    return [j for j in range(k) if set(RULES[k][2]) <= set(RULES[j][2])]


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lines and wrapped (identifier sequences of the two cuts), rules (numbers of
    the rules that hold, from 0), licences and classes (each once, in rule order, comma-separated).

    One row per row; texts without known sentences have empty strings; null texts count
    as empty; other columns are not read; whole texts are read, whatever their length."""
    rows = df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.select("doc_id", identifiers(F.col("text"), False).alias("lines"), identifiers(F.col("text"), True).alias("wrapped"), notices(F.col("text")).alias("notices"))
    hit = [F.col("lines").like(_pattern(r[2])) | F.col("wrapped").like(_pattern(r[2])) | F.col("notices").like(_pattern(r[2])) for r in RULES]
    flags = rows.withColumn("hits", F.array(*hit))
    held = [F.when(F.col("hits")[k] & ~F.array_contains(F.array(F.lit(False), *(F.col("hits")[j] for j in _absorbed(k))), True), F.lit(k)) for k in range(len(RULES))]
    rules = flags.withColumn("rules", F.array_compact(F.array(*held)))
    names, classes = F.array(*(F.lit(r[0]) for r in RULES)), F.array(*(F.lit(r[1]) for r in RULES))
    join = lambda table: F.array_join(F.array_distinct(F.transform("rules", lambda k: F.get(table, k))), ",")
    return rules.select("doc_id", "lines", "wrapped", F.array_join(F.col("rules").cast("array<string>"), ",").alias("rules"), join(names).alias("licences"), join(classes).alias("classes"))


def _sql() -> str:
    """DuckDB's text of ``scan``, without the cut as notices."""
    sentences, rules = SENTENCES[:IN_SQL[0]], RULES[:IN_SQL[1]]
    known = "[" + ", ".join(f"'{s}'" for s in sentences) + "]"
    ids = lambda m: f"list_filter(list_transform(string_split({m}, chr(1)), lambda s: coalesce(list_position({known}, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))), 0)), lambda i: i > 0)"
    seq = lambda m: f"array_to_string(list_transform({ids(m)}, lambda i: '<' || i || '>'), '')"
    lines = r"replace(regexp_replace(t, '([.!?;:])\s+', '\1' || chr(1), 'g'), chr(10), chr(1))"
    wrapped = r"regexp_replace(t, '([.!?;:])\s+|\n\s*\n', '\1' || chr(1), 'g')"
    hits = ", ".join(f"lines LIKE '{_pattern(r[2])}' OR wrapped LIKE '{_pattern(r[2])}'" for r in rules)
    held = ", ".join(f"CASE WHEN h[{k + 1}]" + "".join(f" AND NOT h[{j + 1}]" for j in _absorbed(k)) + f" THEN {k} END" for k in range(len(rules)))
    name = lambda i: "[" + ", ".join(f"'{r[i]}'" for r in rules) + "]"
    once = lambda i: f"coalesce((SELECT string_agg(v, ',' ORDER BY p) FROM (SELECT v, min(k) AS p FROM (SELECT unnest(rules) AS k, unnest(list_transform(rules, lambda r: {name(i)}[r + 1])) AS v) GROUP BY v)), '')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), s AS (SELECT doc_id, {seq(lines)} AS lines, {seq(wrapped)} AS wrapped FROM d),
    f AS (SELECT *, [{hits}] AS h FROM s), r AS (SELECT *, list_filter([{held}], lambda k: k IS NOT NULL) AS rules FROM f)
    SELECT doc_id, lines, wrapped, array_to_string(rules, ',') AS rules, {once(0)} AS licences, {once(1)} AS classes FROM r"""


SQL = _sql()
