"""Licence recognition by sentences and ordered rules.

A text is cut into sentences, at sentence ends and at blank lines, so that a wrapped sentence stays
whole. Each sentence is normalised (lower case, words and version numbers only) and mapped to the
identifier of a known licence sentence; one that is not known is cut at its line ends too, and its
lines are looked up, since headings and single notices have no full stop. Either way a place in the
text gives one identifier, and the text one sequence of them. A known sentence may have a gap
(``<...>``) for a holder's name or an address. Titles are known alone and behind phrases such as
"licensed under the". ``SPDX-License-Identifier:`` lines name their licences themselves.

The sequence is matched with ordered rules: a rule is a licence and the identifiers that state it,
one after another. A rule that matches uses its identifiers up, so that longer and more special
rules, which come first, keep shorter ones from claiming a part of them. Unknown sentences between
known ones do not matter. Sentences and rules are a ``Catalogue``, which a caller can extend.

Everything stays in the row of the document. A pattern passes only texts on that hold a word
without which no known sentence is complete.

Defined cases: NULL and empty texts have no sentences and no licence; a sentence that repeats
counts each time; a licence found more than once is named once; repeated rows are scanned each;
SPDX identifiers come first, exceptions behind WITH are not named, and known ones get their usual case.
"""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

GAP = "<...>"

#: Titles of public licences, by SPDX identifier.
TITLES = {
    "CC-BY-NC-SA-4.0": ["cc by nc sa 4.0", "creative commons attribution noncommercial sharealike 4.0 international license"],
    "CC-BY-NC-4.0": ["cc by nc 4.0", "creative commons attribution noncommercial 4.0 international license"],
    "CC-BY-ND-4.0": ["cc by nd 4.0", "creative commons attribution noderivatives 4.0 international license"],
    "CC-BY-SA-4.0": ["cc by sa 4.0", "creative commons attribution sharealike 4.0 international license"],
    "CC-BY-4.0": ["cc by 4.0", "creative commons attribution 4.0 international license"],
    "CC0-1.0": ["cc0 1.0", "cc0 1.0 universal", "creative commons cc0 1.0 universal"],
    "AGPL-3.0": ["gnu affero general public license version 3", "gnu affero general public license v3.0", "gnu agpl version 3"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "gnu lesser general public license v3.0", "gnu lgpl version 3"],
    "LGPL-2.1": ["gnu lesser general public license version 2.1", "gnu lesser general public license v2.1", "gnu lgpl version 2.1"],
    "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3.0", "gnu gpl version 3", "gnu gplv3"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2.0", "gnu gpl version 2", "gnu gplv2"],
    "MPL-2.0": ["mozilla public license version 2.0", "mozilla public license v 2.0", "mozilla public license 2.0"],
    "EPL-2.0": ["eclipse public license version 2.0", "eclipse public license v2.0", "eclipse public license v 2.0", "eclipse public license 2.0"],
    "EPL-1.0": ["eclipse public license version 1.0", "eclipse public license v1.0", "eclipse public license 1.0"],
    "Apache-2.0": ["apache license version 2.0", "apache license 2.0", "apache 2.0 license", "apache license version 2.0 the license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "revised bsd license"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "bsd 2 clause simplified license"],
    "BSL-1.0": ["boost software license version 1.0"],
    "Zlib": ["zlib license"],
    "ISC": ["isc license"],
    "MIT": ["mit license", "mit licence", "mit x11 license", "expat license"],
    "Unlicense": ["unlicense"],
    "All-rights-reserved": ["all rights reserved"],
}

#: Normalised sentences of public licence texts and notices, by identifier. They are cut
#: where a text is: at full stops, colons and semicolons.
SENTENCES = {
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-0-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"],
    "as-is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "no-liability": ["in no event shall <...> be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "0bsd-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-advert": ["all advertising materials mentioning features or use of this software must display the following acknowledgement"],
    "bsd-endorse": ["neither the name of <...> nor the names of <...> may be used to endorse or promote products derived from this software without specific prior written permission", "neither the names of <...> nor the names of <...> may be used to endorse or promote products derived from this software without specific prior written permission", "the name of <...> may not be used to endorse or promote products derived from this software without specific prior written permission", "the names of <...> may not be used to endorse or promote products derived from this software without specific prior written permission", "neither <...> nor the names of <...> may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-as-is": ["this software is provided by <...> as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"],
    "bsd-no-liability": ["in no event shall <...> be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"],
    "apache-comply": ["you may not use this file except in compliance with the license"],
    "apache-copy": ["you may obtain a copy of the license at http www.apache.org licenses license 2.0", "you may obtain a copy of the license at https www.apache.org licenses license 2.0"],
    "gnu-hope": ["this <...> is distributed in the hope that it will be useful but without any warranty", "<...> is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "version-2-or-later": ["either version 2 of the license or at your option any later version"],
    "version-2.1-or-later": ["either version 2.1 of the license or at your option any later version"],
    "version-3-or-later": ["either version 3 of the license or at your option any later version"],
    "version-2-only": ["version 2 of the license"],
    "version-2.1-only": ["version 2.1 of the license"],
    "version-3-only": ["version 3 of the license"],
    "mpl-subject": ["this source code form is subject to the terms of the mozilla public license v 2.0"],
    "mpl-copy": ["if a copy of the mpl was not distributed with this file you can obtain one at <...> mozilla.org mpl 2.0"],
    "epl-1-terms": ["this program and the accompanying materials are made available under the terms of the eclipse public license v1.0 <...>"],
    "epl-2-terms": ["this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which <...>", "this program and the accompanying materials are made available under the terms of the eclipse public license v2.0 which <...>", "this program and the accompanying materials are made available under the terms of the eclipse public license v 2.0 which <...>"],
    "bsl-grant": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "zlib-origin": ["the origin of this software must not be misrepresented"],
    "zlib-altered": ["altered source versions must be plainly marked as such and must not be misrepresented as being the original software"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}

#: The GNU licences by title, and the versions there are of each.
_GNU = {
    "GPL": ("gnu general public license", ["2", "3"]),
    "LGPL": ("gnu lesser general public license", ["2.1", "3"]),
    "LGPL-library": ("gnu library general public license", ["2"]),
    "AGPL": ("gnu affero general public license", ["3"]),
}
_REDISTRIBUTE = "you can redistribute it and or modify it under the terms of the"
_PUBLISHED = "as published by the free software foundation"

#: Fixed values. Tried in this order.
RULES = [
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-name", "mit-grant", "mit-notice", "as-is", "no-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is", "no-liability"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT-0", ["mit-0-grant", "as-is"]),
    ("ISC", ["isc-name", "isc-grant"]),
    ("ISC", ["isc-grant"]),
    ("0BSD", ["0bsd-grant"]),
    ("Apache-2.0", ["apache-2.0-name", "apache-comply", "apache-copy"]),
    ("Apache-2.0", ["apache-2.0-name", "apache-comply"]),
    ("MPL-2.0", ["mpl-subject", "mpl-copy"]),
    ("MPL-2.0", ["mpl-subject"]),
    ("EPL-1.0", ["epl-1-terms"]),
    ("EPL-2.0", ["epl-2-terms"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("Zlib", ["zlib-grant", "zlib-origin", "zlib-altered"]),
    ("Zlib", ["zlib-grant", "zlib-origin"]),
    ("Unlicense", ["unlicense"]),
]


def _gnu() -> tuple[dict[str, list[str]], list[tuple[str, list[str]]]]:
    """Sentences and rules of the standard notices, from family and version."""
    sentences, rules = {}, []
    for family, (title, versions) in _GNU.items():
        subject, spdx = f"{_REDISTRIBUTE} {title}", family.split("-")[0]
        sentences[f"{family}-details"] = [f"see the {title} for more details"]
        sentences[f"{family}-terms"] = [f"{subject} {_PUBLISHED}", f"<...> is free software {subject} {_PUBLISHED}"]
        for v in versions:
            number = v if "." in v else f"{v}.0"
            for kind, clauses in {
                "or-later": [f"either version {v} of the license or at your option any later version"],
                "only": [f"version {v} of the license", f"version {v}", f"either version {v} of the license"],
            }.items():
                name, licence = f"{family}-{v}-{kind}", f"{spdx}-{number}-{kind}"
                whole = [f"{subject} {_PUBLISHED} {clause}" for clause in clauses]
                if kind == "only":
                    whole.append(f"{subject} version {v} {_PUBLISHED}")
                    whole.append(f"{_REDISTRIBUTE.removesuffix(' the')} version {v} of the {title} {_PUBLISHED}")
                sentences[name] = [*whole, *[f"<...> is free software {s}" for s in whole]]
                rules.append((licence, [f"{family}-terms", f"version-{v}-{kind}"]))
                rules.append((licence, [name]))
    return sentences, rules


@dataclass(frozen=True)
class Catalogue:
    """``titles`` by licence, ``sentences`` by identifier, and ordered ``rules``.

    The title of licence x has identifier ``x-name`` in lower case, with a last rule of its own.
    """

    titles: dict[str, list[str]]
    sentences: dict[str, list[str]]
    rules: list[tuple[str, list[str]]]

    def extended(self, titles=None, sentences=None, rules=()) -> "Catalogue":
        """With more of each; ``rules`` are tried before those there are."""
        return Catalogue(
            self.titles | (titles or {}), self.sentences | (sentences or {}), [*rules, *self.rules]
        )

    def all_rules(self) -> list[tuple[str, list[str]]]:
        return [*self.rules, *[(licence, [f"{licence.lower()}-name"]) for licence in self.titles]]

    def named(self) -> dict[str, str]:
        """Titles, normalised, with their identifiers."""
        return {title: f"{licence.lower()}-name" for licence, titles in self.titles.items() for title in titles}

    def known(self) -> dict[str, str]:
        """Sentences without a gap with their identifiers."""
        return {s: name for name, texts in self.sentences.items() for s in texts if GAP not in s}

    def gapped(self) -> list[tuple[str, str]]:
        """A pattern and the identifier of each sentence with gaps."""
        return [
            ("^" + f".{{1,{LONGEST_GAP}}}?".join(map(re.escape, s.split(GAP))) + "$", name)
            for name, texts in self.sentences.items()
            for s in texts
            if GAP in s
        ]

    def hint(self) -> str:
        """A pattern that every text with a known sentence matches: one word of each."""
        words = {"spdx"}
        every = [*self.named(), *(s for texts in self.sentences.values() for s in texts)]
        for sentence in every:
            own = [w for w in re.findall(r"[a-z0-9.]+", sentence.replace(GAP, " ")) if len(w) > 1]
            if not any(part in w for part in _TELLING for w in own):
                words.add(max(own, key=len))
        return "(?iu)" + "|".join(re.escape(w) for w in sorted({*_TELLING, *words}))


LONGEST_GAP = 160
#: Rare words that most known sentences hold.
_TELLING = ("licens", "permission", "redistribut", "warrant", "liable", "reserved", "unencumbered", "cc0", "misrepresented")
_GNU_SENTENCES, _GNU_RULES = _gnu()
PUBLIC = Catalogue(TITLES, SENTENCES | _GNU_SENTENCES, [*_GNU_RULES, *RULES])

_BLANK = r"\n(?:[^A-Za-z0-9\n]*\n)+"
#: Not behind abbreviations that stand before a name's or a number's end.
_END = rf"(?<=[.!?:;])(?<!\b(?i:inc|ltd|co|corp|v)\.)\s+|{_BLANK}"
_LINE = r"(?<=[.!?:;])\s+|\n"
#: What may come before a title, and before any sentence: the mark of a list.
_UNDER = r"^(?:this (?:project|work|software|program|library|package|file|code) is )?(?:(?:licensed|released|distributed|available|made available) under (?:the terms of )?)?(?:the |an? )?"
_MARK = r"^\(?(?:[0-9]{1,2}|[a-z])\)\s"
_SPDX = r"(?i:SPDX-License-Identifier):[ \t]*((?:\([ \t]*)*[A-Za-z0-9][A-Za-z0-9.+-]*(?:[ \t)]+(?:AND|OR|WITH)[ \t(]+[A-Za-z0-9][A-Za-z0-9.+-]*)*)"
_USED = "-"


def _normalised(sentence: Column) -> Column:
    """Lower-case letters, digits, and dots inside numbers and names; single spaces."""
    bare = F.regexp_replace(F.trim(F.lower(sentence)), _MARK, "")
    kept = F.regexp_replace(bare, r"[^a-z0-9.]+|\.(?![a-z0-9])", " ")
    return F.trim(F.regexp_replace(kept, " +", " "))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _map(pairs: dict[str, str]) -> Column:
    """As one SQL literal, since a plan of many small columns is slow to build."""
    return F.expr(f"map({', '.join(_quoted(x) for pair in pairs.items() for x in pair)})")


def _no_names() -> Column:
    return F.array().cast("array<string>")


def _identifiers(text: Column, of: Catalogue) -> Column:
    known, titles = _map(of.known()), _map(of.named())

    def looked_up(sentence: Column) -> Column:
        name = F.coalesce(
            F.try_element_at(known, sentence),
            F.try_element_at(titles, F.regexp_replace(sentence, _UNDER, "")),
        )
        for pattern, identifier in of.gapped():
            name = F.coalesce(name, F.when(sentence.rlike(pattern), F.lit(identifier)))
        return name

    def at(sentence: Column) -> Column:
        lines = F.transform(F.transform(F.split(sentence, _LINE), _normalised), looked_up)
        whole = F.transform(F.array(_normalised(sentence)), looked_up)
        return F.when(F.get(whole, F.lit(0)).isNotNull(), whole).otherwise(lines)

    named = F.flatten(F.transform(F.split(text, _END), at))
    return F.filter(named, lambda name: name.isNotNull())


def _spdx(text: Column, of: Catalogue) -> Column:
    """The identifiers of SPDX lines, in the catalogue's case if it has them."""
    usual = _map({name.lower(): name for name, _ in of.all_rules()})

    def ids(expression: Column) -> Column:
        bare = F.regexp_replace(expression, r"[ \t)]+WITH[ \t(]+[A-Za-z0-9.+-]+|[()]", " ")
        each = F.split(F.trim(bare), r"[ \t]+(?:AND|OR)[ \t]+")
        return F.transform(each, lambda x: F.coalesce(F.try_element_at(usual, F.lower(F.trim(x))), F.trim(x)))

    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(_SPDX), F.lit(1)), ids))


def _licences(identifiers: Column, of: Catalogue) -> Column:
    """By rules over the identifiers written as ``;a;;b;;c;``."""
    line = F.array_join(F.transform(identifiers, lambda i: F.concat(F.lit(";"), i, F.lit(";"))), "")
    each = [(_quoted(name), _quoted("".join(f";{i};" for i in ids))) for name, ids in of.all_rules()]
    rules = F.expr(f"array({', '.join(f'named_struct("licence", {name}, "ids", {ids})' for name, ids in each)})")
    start = F.struct(line.alias("left"), _no_names().alias("found"))

    def tried(done: Column, rule: Column) -> Column:
        hit = F.contains(done["left"], rule["ids"])
        return F.struct(
            F.replace(done["left"], rule["ids"], F.lit(_USED)).alias("left"),
            F.when(hit, F.array_append(done["found"], rule["licence"])).otherwise(done["found"]).alias("found"),
        )

    return F.aggregate(rules, start, tried, lambda done: done["found"])


def scan(docs: DataFrame, catalogue: Catalogue = PUBLIC) -> DataFrame:
    """``docs`` with ``licence_sentences`` and ``licences``, arrays of names, never NULL."""
    own = ["licence_sentences", "licences"]
    text = F.when(F.col("text").rlike(catalogue.hint()), F.regexp_replace("text", r"\r\n?", "\n"))
    rows = docs.drop(*own).withColumn("_text", text)
    rows = rows.withColumns({"_ids": _identifiers(F.col("_text"), catalogue), "_spdx": _spdx(F.col("_text"), catalogue)})
    found = F.array_distinct(F.concat("_spdx", _licences(F.col("_ids"), catalogue)))
    named = F.concat(F.transform("_spdx", lambda x: F.concat(F.lit("spdx:"), x)), F.col("_ids"))
    return rows.withColumns(
        {"licence_sentences": F.coalesce(named, _no_names()), "licences": F.coalesce(found, _no_names())}
    ).drop("_text", "_ids", "_spdx")
