"""Signature rules of the licence scan, over a text's lower-case words joined by single spaces.

``2.0`` is two words, ``2 0``; ``cc-by-sa`` is three; ``GPLv3`` is one. A family states its keyword, how its name is written and its versions;
the forms below turn every family and version into one rule each. Earlier forms have priority over later ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: (label, keyword every match contains, name, versions)
FAMILIES = (
    ("apache", "apache", "apache(?: software)?", ("1.0", "1.1", "2.0")),
    ("gpl", "gpl", "(?:gnu )?gpl", ("1.0", "2.0", "3.0")),
    ("gpl", "general", "(?:gnu )?general public", ("1.0", "2.0", "3.0")),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", ("2.0", "2.1", "3.0")),
    ("lgpl", "lesser", "(?:gnu )?lesser general public", ("2.1", "3.0")),
    ("lgpl", "library", "(?:gnu )?library general public", ("2.0",)),
    ("agpl", "agpl", "(?:gnu )?agpl", ("1.0", "3.0")),
    ("agpl", "affero", "(?:gnu )?affero general public", ("1.0", "3.0")),
    ("gfdl", "documentation", "(?:gnu )?free documentation", ("1.1", "1.2", "1.3")),
    ("mpl", "mpl", "mpl", ("1.0", "1.1", "2.0")),
    ("mpl", "mozilla", "mozilla public", ("1.0", "1.1", "2.0")),
    ("epl", "eclipse", "eclipse public", ("1.0", "2.0")),
    ("cddl", "cddl", "cddl", ("1.0", "1.1")),
    ("cddl", "distribution", "common development and distribution", ("1.0", "1.1")),
    ("eupl", "eupl", "(?:european union public licence )?eupl", ("1.0", "1.1", "1.2")),
    ("cpl", "common", "common public", ("1.0",)),
    ("ipl", "ibm", "ibm public", ("1.0",)),
    ("artistic", "artistic", "artistic", ("1.0", "2.0")),
    ("afl", "academic", "academic free", ("1.1", "2.0", "2.1", "3.0")),
    ("osl", "open", "open software", ("1.0", "2.0", "2.1", "3.0")),
    ("cecill", "cecill", "cecill", ("1.0", "2.0", "2.1")),
    ("apsl", "apple", "apple public source", ("1.0", "1.1", "2.0")),
    ("zpl", "zope", "zope public", ("1.1", "2.0", "2.1")),
    ("ofl", "ofl", "(?:sil )?(?:open font license )?ofl", ("1.0", "1.1")),
    ("ofl", "font", "(?:sil )?open font", ("1.0", "1.1")),
    ("boost", "boost", "boost software", ("1.0",)),
    ("busl", "business", "business source", ("1.0", "1.1")),
    ("elastic", "elastic", "elastic", ("2.0",)),
    ("sspl", "server", "server side public", ("1.0",)),
    ("odbl", "database", "open database", ("1.0",)),
    ("odc-by", "data", "open data commons attribution", ("1.0",)),
    ("php", "php", "php", ("3.0", "3.01")),
    ("python", "python", "python(?: software foundation)?", ("2.0",)),
    ("ecl", "educational", "educational community", ("1.0", "2.0")),
    ("lppl", "latex", "latex project public", ("1.0", "1.1", "1.2", "1.3")),
    ("nasa", "nasa", "nasa open source agreement", ("1.3",)),
    ("rpl", "reciprocal", "reciprocal public", ("1.1", "1.5")),
    ("cpal", "attribution", "common public attribution", ("1.0",)),
    ("mulan", "mulan", "mulan (?:psl|permissive software)", ("1.0", "2.0")),
    ("mit", "mit", "mit", ()),
    ("mit", "expat", "expat", ()),
    ("isc", "isc", "isc", ()),
    ("bsd", "bsd", "(?:(?:new|revised|modified|simplified|original) )?bsd", ()),
    ("bsd-0-clause", "bsd", "(?:0|zero) clause bsd", ()),
    ("bsd-2-clause", "bsd", "(?:2|two) clause bsd", ()),
    ("bsd-3-clause", "bsd", "(?:3|three) clause bsd", ()),
    ("bsd-4-clause", "bsd", "(?:4|four) clause bsd", ()),
    ("zlib", "zlib", "zlib(?: libpng)?", ()),
    ("x11", "x11", "x11", ()),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)?", ()),
    ("postgresql", "postgresql", "postgresql", ()),
    ("openssl", "openssl", "openssl", ()),
    ("ruby", "ruby", "ruby", ()),
    ("vim", "vim", "vim", ()),
    ("w3c", "w3c", "w3c(?: software)?", ()),
    ("unicode", "unicode", "unicode", ()),
    ("ms-pl", "microsoft", "microsoft public", ()),
    ("ms-rl", "microsoft", "microsoft reciprocal", ()),
    ("qpl", "q", "q public", ()),
    ("json", "json", "json", ()),
    ("beerware", "beerware", "beerware", ()),
    ("wtfpl", "wtfpl", "wtfpl", ()),
    ("hpnd", "historical", "historical permission notice", ()),
    ("upl", "universal", "universal permissive", ()),
    ("blue-oak", "oak", "blue oak model", ()),
    ("polyform", "polyform", "polyform (?:noncommercial|small business|shield|strict|perimeter)", ()),
)

#: (label, acronym, versions) of names that a version may follow without a gap; each form is a keyword of its own
JOINED = (
    ("apache", "apachev", ("1.0", "1.1", "2.0")),  # apache2 names a web server
    *[(label, acronym, versions) for label, name, versions in (
        ("gpl", "gpl", ("1.0", "2.0", "3.0")), ("lgpl", "lgpl", ("2.0", "2.1", "3.0")), ("agpl", "agpl", ("1.0", "3.0")),
        ("gfdl", "gfdl", ("1.1", "1.2", "1.3")), ("mpl", "mpl", ("1.0", "1.1", "2.0")), ("epl", "epl", ("1.0", "2.0")),
        ("cddl", "cddl", ("1.0", "1.1")), ("eupl", "eupl", ("1.0", "1.1", "1.2")), ("afl", "afl", ("1.1", "2.0", "2.1", "3.0")),
        ("osl", "osl", ("1.0", "2.0", "2.1", "3.0")), ("apsl", "apsl", ("1.0", "1.1", "2.0")), ("zpl", "zpl", ("1.1", "2.0", "2.1")),
        ("ofl", "ofl", ("1.0", "1.1")), ("cecill", "cecill", ("1.0", "2.0", "2.1")), ("sspl", "sspl", ("1.0",)),
    ) for acronym in (name + "v", name)],
)

#: (label, identifier, versions) of SPDX lines whose identifier is not a family's name before a version
IDENTIFIERS = (
    ("mit", "(?:mit|expat)", ()), ("mit-0", "mit 0", ()), ("isc", "isc", ()), ("bsd-0-clause", "0bsd", ()),
    ("bsd-2-clause", "bsd 2 clause", ()), ("bsd-3-clause", "bsd 3 clause", ()), ("bsd-4-clause", "bsd 4 clause", ()),
    ("zlib", "zlib", ()), ("x11", "x11", ()), ("ncsa", "ncsa", ()), ("postgresql", "postgresql", ()), ("openssl", "openssl", ()),
    ("ruby", "ruby", ()), ("vim", "vim", ()), ("w3c", "w3c", ()), ("unicode", "unicode(?: dfs 201[56]| 3 0| tou)?", ()),
    ("ms-pl", "ms pl", ()), ("ms-rl", "ms rl", ()), ("qpl", "qpl(?: 1 0)?", ()), ("json", "json", ()), ("beerware", "beerware", ()),
    ("wtfpl", "wtfpl", ()), ("hpnd", "hpnd", ()), ("upl", "upl(?: 1 0)?", ()), ("blue-oak", "blueoak 1 0 0", ()),
    ("polyform", "polyform (?:noncommercial|small business) 1 0 0", ()), ("unlicense", "unlicense", ()),
    ("gfdl", "gfdl", ("1.1", "1.2", "1.3")), ("epl", "epl", ("1.0", "2.0")), ("cpl", "cpl", ("1.0",)), ("ipl", "ipl", ("1.0",)),
    ("afl", "afl", ("1.1", "2.0", "2.1", "3.0")), ("osl", "osl", ("1.0", "2.0", "2.1", "3.0")),
    ("apsl", "apsl", ("1.0", "1.1", "2.0")), ("zpl", "zpl", ("1.1", "2.0", "2.1")), ("boost", "bsl", ("1.0",)),
    ("busl", "busl", ("1.0", "1.1")), ("sspl", "sspl", ("1.0",)), ("odbl", "odbl", ("1.0",)), ("odc-by", "odc by", ("1.0",)),
    ("python", "psf", ("2.0",)), ("ecl", "ecl", ("1.0", "2.0")), ("lppl", "lppl", ("1.0", "1.1", "1.2", "1.3", "1.3a", "1.3c")),
    ("nasa", "nasa", ("1.3",)), ("rpl", "rpl", ("1.1", "1.5")), ("cpal", "cpal", ("1.0",)), ("mulan", "mulanpsl", ("1.0", "2.0")),
)

#: (word form of the terms, label)
CREATIVE = (
    ("by", "by"), ("by sa", "by-sa"), ("by nc", "by-nc"), ("by nd", "by-nd"), ("by nc sa", "by-nc-sa"),
    ("by nc nd", "by-nc-nd"),
)
CREATIVE_NAMES = {
    "by": "attribution", "by sa": "attribution share ?alike", "by nc": "attribution non ?commercial",
    "by nd": "attribution no ?deriv(?:ative)?s", "by nc sa": "attribution non ?commercial share ?alike",
    "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s",
}
CREATIVE_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

#: (label, keyword, words) of single notices
NOTICES = (
    ("public-domain", "domain", "(?:released|placed|dedicated|dedicate) (?:in|into|to) the public domain"),
    ("public-domain", "domain", "this work is in the public domain"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", "zero", "creative commons zero"),
    ("cc0-1.0", "publicdomain", "creativecommons org publicdomain zero 1 0"),
    ("mit", "granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("zlib", "altered", "altered source versions must be plainly marked as such"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license"),
    ("warranty-disclaimer", "warranties", "without warranties or conditions of any kind"),
    ("warranty-disclaimer", "warranty", "without warranty of any kind(?: express or implied)?"),
    ("warranty-disclaimer", "provided", "(?:the|this) software is provided as is"),
    ("reserved", "reserved", "(?:some|all) rights reserved"),
    ("reserved", "vorbehalten", "alle rechte vorbehalten"),
    ("reserved", "réservés", "tous droits réservés"),
    ("reserved", "reservados", "todos los derechos reservados"),
    ("proprietary", "proprietary", "proprietary and confidential"),
    ("proprietary", "unauthorized", "unauthorized (?:copying|use|reproduction|distribution)"),
    ("non-commercial", "commercial", "(?:for )?non commercial use only"),
    ("permission-required", "permission", "(?:reproduced|used|reprinted) (?:with|by) permission"),
    ("copyright-notice", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]"),
)


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    keyword: str
    priority: int  # smaller wins
    pattern: re.Pattern


def words_of(version: str) -> str:
    """The version's words; a last zero may be left out."""
    return f"{version[:-2]}(?: 0)?" if version.count(".") == 1 and version.endswith(".0") else version.replace(".", " ")


def build_rules() -> tuple[Rule, ...]:
    """Every rule, in order of priority; a pattern matches whole words of UTF-8 text."""
    rules = []

    def add(label, keyword, priority, words):
        pattern = re.compile(f"(?<![^ ])(?:{words})(?![^ ])".encode())
        rules.append(Rule(f"{label}/{priority}/{len(rules)}", label, keyword, priority, pattern))

    for label, keyword, words in NOTICES:
        add(label, keyword, 0, words)
    later = "(?: or(?: at your option)?(?: any)? later(?: version)?)?"
    for label, keyword, name, versions in FAMILIES:
        for version in versions:
            full, v = f"{label}-{version}", f"(?:v(?:ersion)? ?)?{words_of(version)}"
            add(full, keyword, 1, f"(?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of the )?{name}(?: licen[cs]e)? {v}{later}")
            add(full, keyword, 2, f"spdx license identifier {name} {words_of(version)}(?: only| or later)?")
            add(full, keyword, 3, f"{name}(?: licen[cs]e)? {v}{later}")
        add(label, keyword, 4, f"(?:licen[sc]ed|released|distributed|available) under (?:the |an? )?(?:terms of the )?{name}(?: style)? licen[cs]e")
        add(label, keyword, 5, f"{name}(?: style)? licen[cs]e")
    for label, acronym, versions in JOINED:
        for version in versions:
            full, keyword, name = f"{label}-{version}", acronym + version[0], f"(?:gnu )?{acronym}{words_of(version)}"
            add(full, keyword, 1, f"(?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of the )?{name}(?: licen[cs]e)?{later}")
            add(full, keyword, 3, f"{name}(?: licen[cs]e)?{later}")
    for label, identifier, versions in IDENTIFIERS:
        for version in versions:
            add(f"{label}-{version}", "spdx", 2, f"spdx license identifier {identifier} {words_of(version)}(?: only| or later)?")
        if not versions:
            add(label, "spdx", 2, f"spdx license identifier {identifier}")
    for terms, label in CREATIVE:
        for version in CREATIVE_VERSIONS:
            full, v = f"cc-{label}-{version}", words_of(version)
            add(full, "cc", 3, f"cc {terms} (?:v )?{v}")
            add(full, "commons", 3, f"creative commons {CREATIVE_NAMES[terms]} {v}")
            add(full, "creativecommons", 2, f"creativecommons org licenses {terms} {v}")
        add(f"cc-{label}", "cc", 5, f"cc {terms}")
        add(f"cc-{label}", "commons", 5, f"creative commons {CREATIVE_NAMES[terms]}")
    return tuple(sorted(rules, key=lambda r: r.priority))


RULES = build_rules()
