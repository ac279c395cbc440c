"""License scans by sentence rules, in DataFrame functions only.

Each sentence of a text is normalised (A-Z lowered, everything but a-z and 0-9 one space) and looked up
among known licence sentences, which gives an identifier. A sentence may be wrapped: it is known if it
fills whole lines or parts of lines between sentence marks, one after the other without a blank line
between them; of several known sentences that begin at one place the longest counts. A rule is an ordered
list of identifiers; a licence is recognised where a rule's identifiers follow one another in the text's
sequence of identifiers. Sentences that are not known do not interrupt a sequence: a line may hold a name.

Defined results: null and empty texts have no sentences and no licence; a sentence that occurs twice is
twice in the sequence; a licence recognised by several rules or places is named once; repeated rows are
treated alike; empty tables give no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentences of public licences and notices, normalised, by identifier.
SENTENCES = {
    "apache-2.0.notice": "licensed under the apache license version 2 0",
    "apache-2.0.comply": "you may not use this file except in compliance with the license",
    "apache-2.0.copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-2.0.copy2": "you may obtain a copy of the license at https www apache org licenses license 2 0",
    "apache-2.0.notice2": "licensed under the apache license version 2 0 the license",
    "apache-2.0.header": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache-2.0.asf": "the asf licenses this file to you under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache-2.0.title": "apache license version 2 0 january 2004",
    "mit.notice": "released under the mit license",
    "mit.notice2": "this project is licensed under the mit license",
    "mit.notice3": "licensed under the mit license",
    "mit.notice4": "this project is licensed under the mit license see the license file for details",
    "mit.notice5": "this project is licensed under the mit license see the license license file for details",
    "mit.notice6": "this project is licensed under the mit license see the license md file for details",
    "mit.notice7": "this project is licensed under the mit license see the license md license md file for details",
    "mit.title": "mit license",
    "mit.grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit.condition": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit.condition2": "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software",
    "gpl-3.0.notice": "this work is licensed under the gnu general public license version 3",
    "gpl-3.0.notice2": "licensed under the gnu general public license version 3",
    "gpl.free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl.free2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-2.0.only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "agpl-3.0.free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-3.0.free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-2.1.free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "gpl.warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl.warranty": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-2.0.notice": "licensed under the gnu general public license version 2",
    "lgpl-3.0.notice": "licensed under the gnu lesser general public license version 3",
    "agpl-3.0.notice": "licensed under the gnu affero general public license version 3",
    "bsd.redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd.style": "use of this source code is governed by a bsd style license that can be found in the license file",
    "bsd.notice": "licensed under the bsd 3 clause license",
    "bsd.notice2": "licensed under the bsd 2 clause license",
    "mpl-2.0.notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-2.0.notice2": "this source code form is subject to the terms of the mozilla public license v",
    "cc-by-nc-4.0.notice": "licensed under cc by nc 4 0",
    "cc-by-4.0.notice": "licensed under cc by 4 0",
    "cc-by-sa-4.0.notice": "licensed under cc by sa 4 0",
    "cc-by-4.0.work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0.work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by-4.0.work2": "this work is licensed under the creative commons attribution 4 0 international license",
    "cc-by-nc-4.0.work2": "this work is licensed under the creative commons attribution noncommercial 4 0 international license",
    "cc-by-sa-4.0.work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-sa-4.0.work2": "this work is licensed under the creative commons attribution sharealike 4 0 international license",
    "cc0.notice": "this work is dedicated to the public domain under cc0 1 0",
    "unlicense.notice": "this is free and unencumbered software released into the public domain",
    "isc.grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "zlib.grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "bsl-1.0.title": "boost software license version 1 0 august 17th 2003",
    "epl-2.0.title": "eclipse public license v 2 0",
    "wtfpl.title": "do what the fuck you want to public license",
    "bsd.third": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd.disclaimer": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
}
#: Ordered rules and the licence that each stands for.
RULES = [
    ("Apache-2.0", ["apache-2.0.notice"]),
    ("Apache-2.0", ["apache-2.0.comply", "apache-2.0.copy"]),
    ("Apache-2.0", ["apache-2.0.comply", "apache-2.0.copy2"]),
    ("Apache-2.0", ["apache-2.0.notice2"]),
    ("Apache-2.0", ["apache-2.0.header"]),
    ("Apache-2.0", ["apache-2.0.asf"]),
    ("Apache-2.0", ["apache-2.0.title"]),
    ("MIT", ["mit.notice"]),
    ("MIT", ["mit.notice2"]),
    ("MIT", ["mit.notice3"]),
    ("MIT", ["mit.grant", "mit.condition"]),
    ("MIT", ["mit.grant", "mit.condition2"]),
    ("MIT", ["mit.notice4"]),
    ("MIT", ["mit.notice5"]),
    ("MIT", ["mit.notice6"]),
    ("MIT", ["mit.notice7"]),
    ("GPL-3.0", ["gpl-3.0.notice"]),
    ("GPL-3.0", ["gpl-3.0.notice2"]),
    ("GPL-3.0", ["gpl.free", "gpl.warranty"]),
    ("GPL-2.0", ["gpl.free2", "gpl.warranty"]),
    ("GPL-2.0", ["gpl-2.0.only"]),
    ("GPL-2.0", ["gpl-2.0.notice"]),
    ("LGPL-3.0", ["lgpl-3.0.notice"]),
    ("LGPL-3.0", ["lgpl-3.0.free", "lgpl.warranty"]),
    ("LGPL-2.1", ["lgpl-2.1.free", "lgpl.warranty"]),
    ("AGPL-3.0", ["agpl-3.0.notice"]),
    ("AGPL-3.0", ["agpl-3.0.free", "gpl.warranty"]),
    ("BSD", ["bsd.redistribution"]),
    ("BSD", ["bsd.style"]),
    ("BSD-3-Clause", ["bsd.notice"]),
    ("BSD-2-Clause", ["bsd.notice2"]),
    ("MPL-2.0", ["mpl-2.0.notice"]),
    ("MPL-2.0", ["mpl-2.0.notice2"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4.0.notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4.0.work"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4.0.work2"]),
    ("CC-BY-4.0", ["cc-by-4.0.notice"]),
    ("CC-BY-4.0", ["cc-by-4.0.work"]),
    ("CC-BY-4.0", ["cc-by-4.0.work2"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4.0.notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4.0.work"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4.0.work2"]),
    ("CC0-1.0", ["cc0.notice"]),
    ("Unlicense", ["unlicense.notice"]),
    ("ISC", ["isc.grant"]),
    ("Zlib", ["zlib.grant"]),
    ("BSL-1.0", ["bsl-1.0.title"]),
    ("EPL-2.0", ["epl-2.0.title"]),
    ("WTFPL", ["wtfpl.title"]),
    ("BSD-3-Clause", ["bsd.redistribution", "bsd.third"]),
    ("BSD-2-Clause", ["bsd.redistribution", "bsd.disclaimer"]),
]
#: How notices begin, and the names they give a licence.
NOTICES = ("licensed under", "released under", "distributed under", "this project is licensed under", "this software is licensed under")
NAMES = {
    "Apache-2.0": "apache license version 2 0", "MIT": "mit license", "GPL-2.0": "gnu general public license version 2",
    "GPL-3.0": "gnu general public license version 3", "LGPL-3.0": "gnu lesser general public license version 3",
    "AGPL-3.0": "gnu affero general public license version 3", "BSD-2-Clause": "bsd 2 clause license",
    "BSD-3-Clause": "bsd 3 clause license", "MPL-2.0": "mozilla public license version 2 0", "ISC": "isc license",
    "Zlib": "zlib license", "BSL-1.0": "boost software license version 1 0", "EPL-2.0": "eclipse public license version 2 0",
}
#: Licences that SPDX tags name, and those that tags name with -only or -or-later.
TAGS = ("Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "ISC", "Zlib", "BSL-1.0", "EPL-2.0", "WTFPL", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0")
DATED_TAGS = ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")


def _plain(name: str) -> str:
    return re.sub("[^a-z0-9]+", " ", name.lower())


def _built() -> list[tuple[str, str, str]]:
    """(licence, identifier, sentence) of the notices in usual words and of the SPDX tags."""
    found = [
        (name, f"{name.lower()}.{_plain(lead).replace(' ', '-')}{k}", f"{lead} {of} {title}")
        for name, title in NAMES.items() for lead in NOTICES for k, of in enumerate(("the", "the terms of the"))
    ]
    tags = [(name, name) for name in TAGS] + [(name, name + end) for name in DATED_TAGS for end in ("", "-only", "-or-later")]
    return found + [(name, f"spdx.{tag.lower()}", f"spdx license identifier {_plain(tag)}") for name, tag in tags]


for _name, _id, _sentence in _built():
    if _sentence not in SENTENCES.values():
        SENTENCES[_id] = _sentence
        RULES.append((_name, [_id]))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """The text, normalised, in lines; an empty line where a sentence or a paragraph ends.

    A sentence ends at one of . ! ? that follows another character and precedes white space: abbreviations
    aside, doubled marks do not end it. A line feed alone may be in the middle of one.
    """
    lower = F.translate(text, _UPPER, _LOWER)
    lined = F.regexp_replace(lower, "([^.!?\\n][.!?])(?:[ \\t\\r]+\\n?|\\n)", "$1\n\n")
    return F.regexp_replace(lined, "[^a-z0-9\\n]+", " ")


def identified(text: Column, known: dict[str, str] = SENTENCES) -> Column:
    """The identifiers of the known sentences, in text order: words apart by a space or by one line feed, from the
    beginning of a line to the end of the same or a later one."""
    by_text = F.create_map(*[F.lit(x) for name, sentence in known.items() for x in (sentence, name)])
    longest_first = sorted(known.values(), key=lambda s: (-len(s), s))
    by_word: dict[str, list[str]] = {}
    for sentence in longest_first:
        by_word.setdefault(sentence.split(" ")[0], []).append(sentence.replace(" ", "(?: ?\\n ?| )"))
    pattern = "(?:^|\\n) ?(" + "|".join(f"(?={word})(?:{'|'.join(found)})" for word, found in sorted(by_word.items())) + ")(?= ?(?:\\n|\\z))"
    found = F.regexp_extract_all(normalised(text), F.lit(pattern), F.lit(1))
    return F.transform(found, lambda s: F.try_element_at(by_text, F.regexp_replace(s, "[ \\n]+", " ")))


def licences(ids: Column, rules: list[tuple[str, list[str]]] = RULES) -> Column:
    """Names of the licences whose rule matches consecutive identifiers, sorted."""
    joined = F.concat(F.lit("\n"), F.concat_ws("\n\n", ids), F.lit("\n"))
    found = [F.when(joined.contains("\n" + "\n\n".join(rule) + "\n"), F.lit(name)) for name, rule in rules if len(rule) > 1]
    alone: dict[str, list[str]] = {}
    for name, rule in rules:
        if len(rule) == 1:
            alone.setdefault(rule[0], []).append(name)
    several = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    if alone:
        by_id = F.create_map(*[x for i, names in alone.items() for x in (F.lit(i), F.array(*map(F.lit, names)))])
        several = F.concat(several, F.flatten(F.array_compact(F.transform(ids, lambda i: F.try_element_at(by_id, i)))))
    return F.array_sort(F.array_distinct(several))


def scanned(documents: DataFrame, text: str = "text") -> DataFrame:
    """Adds sentence_ids and licenses (arrays); older columns of these names are replaced."""
    # Every known sentence has one of these words; a text without any skips the cutting.
    hint = F.translate(F.col(text), _UPPER, _LOWER).rlike("licen[sc]e|permission|program|redistribution|copyright|domain|warranty")
    known = F.when(hint, identified(F.col(text))).otherwise(F.array().cast("array<string>"))
    return documents.withColumn("sentence_ids", F.coalesce(known, F.array().cast("array<string>"))).withColumn(
        "licenses", F.when(F.size("sentence_ids") > 0, licences(F.col("sentence_ids"))).otherwise(F.array().cast("array<string>"))
    )
