"""Signature rules for licence scans.

Patterns read a text's words (lower case, letters and digits only) with one space between two words, so that
"Apache License, Version 2.0" is ``apache license version 2 0``. A pattern begins and ends at whole words.
"""

from __future__ import annotations

from dataclasses import dataclass

TEXT, GRANT, NAME, CLUE = 4, 3, 2, 1
CONFIDENCE = {TEXT: 1.0, GRANT: 0.95, NAME: 0.8, CLUE: 0.4}


@dataclass(frozen=True)
class Rule:
    """``keywords`` are words that every match holds; a higher ``priority`` wins over what it contains."""

    label: str
    keywords: tuple[str, ...]
    pattern: str
    priority: int

    @property
    def regex(self) -> str:
        """The pattern over words with a space on either side, so that neighbouring matches share nothing."""
        return " " + self.pattern.replace(" ", "  ") + " "


_V = "(?: version)?"
_L = "licen[sc]e"

#: Label, keyword, how the licence is named in prose, and the words of its SPDX identifier.
NAMED = [
    ("mit", "mit", f"mit(?: x11)? {_L}", "mit"),
    ("mit-0", "mit", f"mit no attribution(?: {_L})?", "mit 0"),
    ("apache-1", "apache", f"apache(?: software)? {_L}{_V} v?1(?: 0)?", "apache 1 0"),
    ("apache-1.1", "apache", f"apache(?: software)? {_L}{_V} v?1 1", "apache 1 1"),
    ("apache-2", "apache", f"apache(?: software)?(?: {_L})?{_V} v?2(?: 0)?(?: {_L})?", "apache 2 0"),
    ("apache", "apache", f"apache(?: software)? {_L}", "apache"),
    ("bsd", "bsd", f"bsd(?: style)? {_L}", "bsd"),
    ("bsd-2", "bsd", f"(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd bsd)(?: {_L})?", "bsd 2 clause"),
    ("bsd-3", "bsd", f"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)(?: {_L})?", "bsd 3 clause"),
    ("bsd-4", "bsd", f"(?:original bsd|bsd 4 clause|4 clause bsd)(?: {_L})?", "bsd 4 clause"),
    ("0bsd", "0bsd", f"0bsd(?: {_L})?", "0bsd"),
    ("isc", "isc", f"isc {_L}", "isc"),
    ("gpl", "general", f"(?:gnu )?general public {_L}", "gpl"),
    ("gpl-1", "general", f"(?:gnu )?general public {_L}{_V} v?1(?: 0)?", "gpl 1 0"),
    ("gpl-2", "general", f"(?:gnu )?general public {_L}{_V} v?2(?: 0)?", "gpl 2 0"),
    ("gpl-3", "general", f"(?:gnu )?general public {_L}{_V} v?3(?: 0)?", "gpl 3 0"),
    ("lgpl", "lesser", f"(?:gnu )?lesser general public {_L}", "lgpl"),
    ("lgpl-2", "library", f"(?:gnu )?library general public {_L}{_V} v?2(?: 0)?", "lgpl 2 0"),
    ("lgpl-2.1", "lesser", f"(?:gnu )?lesser general public {_L}{_V} v?2 1", "lgpl 2 1"),
    ("lgpl-3", "lesser", f"(?:gnu )?lesser general public {_L}{_V} v?3(?: 0)?", "lgpl 3 0"),
    ("agpl", "affero", f"(?:gnu )?affero general public {_L}", "agpl"),
    ("agpl-3", "affero", f"(?:gnu )?affero general public {_L}{_V} v?3(?: 0)?", "agpl 3 0"),
    ("gfdl", "documentation", f"(?:gnu )?free documentation {_L}", "gfdl"),
    ("gfdl-1.2", "documentation", f"(?:gnu )?free documentation {_L}{_V} v?1 2", "gfdl 1 2"),
    ("gfdl-1.3", "documentation", f"(?:gnu )?free documentation {_L}{_V} v?1 3", "gfdl 1 3"),
    ("mpl", "mozilla", f"mozilla public {_L}", "mpl"),
    ("mpl-1.1", "mozilla", f"mozilla public {_L}{_V} v?1 1", "mpl 1 1"),
    ("mpl-2", "mozilla", f"mozilla public {_L}{_V} v?2(?: 0)?", "mpl 2 0"),
    ("epl-1", "eclipse", f"eclipse public {_L}{_V} v?1(?: 0)?", "epl 1 0"),
    ("epl-2", "eclipse", f"eclipse public {_L}{_V} v?2(?: 0)?", "epl 2 0"),
    ("edl-1", "eclipse", f"eclipse distribution {_L}(?: v1 0)?", "edl 1 0"),
    ("cddl-1", "distribution", f"common development and distribution {_L}", "cddl 1 0"),
    ("cpl-1", "common", f"common public {_L}", "cpl 1 0"),
    ("ipl-1", "ibm", f"ibm public {_L}", "ipl 1 0"),
    ("eupl-1.1", "european", f"european union public {_L}{_V} v?1 1", "eupl 1 1"),
    ("eupl-1.2", "european", f"european union public {_L}{_V} v?1 2", "eupl 1 2"),
    ("cecill-2", "cecill", f"cecill(?: free software)? {_L}", "cecill 2 1"),
    ("cecill-b", "cecill", f"cecill b(?: {_L})?", "cecill b"),
    ("cecill-c", "cecill", f"cecill c(?: {_L})?", "cecill c"),
    ("artistic-1", "artistic", f"artistic {_L}", "artistic 1 0"),
    ("artistic-2", "artistic", f"artistic {_L}{_V} v?2(?: 0)?", "artistic 2 0"),
    ("zlib", "zlib", f"zlib {_L}", "zlib"),
    ("libpng", "libpng", f"(?:zlib )?libpng {_L}", "libpng"),
    ("boost-1", "boost", f"boost software {_L}(?: version)?(?: 1 0)?", "bsl 1 0"),
    ("unlicense", "unlicense", "the unlicense", "unlicense"),
    ("wtfpl", "wtfpl", f"wtfpl(?: version 2)?(?: {_L})?", "wtfpl"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by", "cc", "cc by(?: [1-4] [05])?", "cc by 4 0"),
    ("cc-by-sa", "cc", "cc by sa(?: [1-4] [05])?", "cc by sa 4 0"),
    ("cc-by-nd", "cc", "cc by nd(?: [1-4] [05])?", "cc by nd 4 0"),
    ("cc-by-nc", "cc", "cc by nc(?: [1-4] [05])?", "cc by nc 4 0"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1-4] [05])?", "cc by nc sa 4 0"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1-4] [05])?", "cc by nc nd 4 0"),
    ("odbl-1", "database", f"open(?: data commons)?(?: open)? database {_L}", "odbl 1 0"),
    ("pddl-1", "dedication", f"public domain dedication and {_L}", "pddl 1 0"),
    ("odc-by-1", "commons", f"open data commons attribution {_L}", "odc by 1 0"),
    ("ofl-1.1", "font", f"(?:sil )?open font {_L}(?: version)?(?: 1 1)?", "ofl 1 1"),
    ("python-2", "python", f"python(?: software foundation)? {_L}", "python 2 0"),
    ("ruby", "ruby", f"ruby {_L}", "ruby"),
    ("php-3", "php", f"php {_L}(?: version)?(?: 3 0[01])?", "php 3 01"),
    ("openssl", "openssl", f"openssl {_L}", "openssl"),
    ("ncsa", "ncsa", f"(?:university of illinois )?ncsa(?: open source)? {_L}", "ncsa"),
    ("postgresql", "postgresql", f"postgresql {_L}", "postgresql"),
    ("ms-pl", "microsoft", f"microsoft public {_L}", "ms pl"),
    ("ms-rl", "microsoft", f"microsoft reciprocal {_L}", "ms rl"),
    ("afl-3", "academic", f"academic free {_L}", "afl 3 0"),
    ("osl-3", "osl", f"osl(?: 3 0)? {_L}", "osl 3 0"),
    ("apsl-2", "apple", f"apple public source {_L}", "apsl 2 0"),
    ("qpl-1", "q", f"q public {_L}", "qpl 1 0"),
    ("sleepycat", "sleepycat", f"sleepycat {_L}", "sleepycat"),
    ("w3c", "w3c", f"w3c software(?: notice)?(?: and)? {_L}", "w3c"),
    ("x11", "x11", f"x11 {_L}", "x11"),
    ("vim", "vim", f"vim {_L}", "vim"),
    ("tcl", "tcl", f"tcl(?: tk)? {_L}", "tcl"),
    ("unicode", "unicode", f"unicode {_L}(?: agreement)?", "unicode dfs 2016"),
    ("icu", "icu", f"icu {_L}", "icu"),
    ("beerware", "beerware", f"beerware {_L}", "beerware"),
    ("busl-1.1", "business", f"business source {_L}(?: 1 1)?", "busl 1 1"),
    ("sspl-1", "server", f"server side public {_L}", "sspl 1 0"),
    ("elastic-2", "elastic", f"elastic {_L}(?: 2 0)?", "elastic 2 0"),
    ("commons-clause", "clause", "commons clause(?: license condition)?", "commons clause"),
    ("polyform-nc-1", "polyform", f"polyform noncommercial {_L}", "polyform noncommercial 1 0 0"),
    ("openrail", "openrail", f"(?:creativeml |bigscience )?openrail(?: m)?(?: {_L})?", "openrail"),
    ("blueoak-1", "oak", f"blue oak model {_L}", "blueoak 1 0 0"),
    ("upl-1", "permissive", f"universal permissive {_L}", "upl 1 0"),
    ("mulan-2", "mulan", f"mulan(?: permissive software| psl)? {_L}", "mulanpsl 2 0"),
    ("hippocratic", "hippocratic", f"hippocratic {_L}", "hippocratic 2 1"),
    ("etalab-2", "etalab", f"(?:licence ouverte )?etalab(?: {_L})?(?: 2 0)?", "etalab 2 0"),
    ("ogl-uk-3", "government", f"open government {_L}", "ogl uk 3 0"),
    ("zpl-2", "zope", f"zope public {_L}", "zpl 2 1"),
    ("xfree86", "xfree86", f"xfree86 {_L}", "xfree86 1 1"),
    ("imagemagick", "imagemagick", f"imagemagick {_L}", "imagemagick"),
    ("curl", "curl", f"curl {_L}", "curl"),
    ("ftl", "freetype", f"freetype(?: project)? {_L}", "ftl"),
    ("ijg", "jpeg", f"independent jpeg group(?: {_L})?", "ijg"),
    ("nasa-1.3", "nasa", f"nasa open source agreement", "nasa 1 3"),
    ("lppl-1.3", "latex", f"latex project public {_L}", "lppl 1 3c"),
    ("sissl", "sun", f"sun industry standards source {_L}", "sissl"),
    ("watcom-1", "watcom", f"sybase open watcom public {_L}", "watcom 1 0"),
    ("rpl-1.5", "reciprocal", f"reciprocal public {_L}", "rpl 1 5"),
]

#: Sentences of licence texts and notices: label, keywords, pattern, priority.
SENTENCES = [
    ("mit", ("hereby", "deal"), "permission is hereby granted free of charge to any person obtaining a copy(?: of this software and associated documentation files the software)? to deal in the software without restriction", TEXT),
    ("mit", ("portions",), "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", TEXT),
    ("isc", ("fee", "purpose"), "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", TEXT),
    ("apache-2", ("apache", "except"), "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", TEXT),
    ("apache-2", ("apache", "org"), "(?:https? )?(?:www )?apache org licenses license 2 0", GRANT),
    ("bsd", ("redistribution", "binary"), "redistribution and use in source and binary forms with or without modification are permitted", TEXT),
    ("bsd-3", ("endorse", "promote"), "may be used to endorse or promote products derived from this software without specific prior written permission", TEXT),
    ("bsd-4", ("advertising", "acknowledgement"), "all advertising materials mentioning features or use of this software must display the following acknowledgement", TEXT),
    ("gpl", ("gnu", "redistribute"), "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", TEXT),
    ("gpl-2", ("gnu", "redistribute"), "you can redistribute it and or modify it under the terms of the gnu general public license(?: version 2)? as published by the free software foundation(?: either)? version 2(?: of the license)?", TEXT),
    ("gpl-3", ("gnu", "redistribute"), "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation(?: either)? version 3(?: of the license)?", TEXT),
    ("lgpl", ("gnu", "lesser", "redistribute"), "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", TEXT),
    ("agpl-3", ("gnu", "affero", "redistribute"), "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", TEXT),
    ("gpl", ("gpl",), "(?:gnu )?gpl", NAME),
    ("gpl-2", ("gpl",), "(?:gnu )?gpl(?: version)?(?: v)? v?2(?: 0)?", NAME),
    ("gpl-3", ("gpl",), "(?:gnu )?gpl(?: version)?(?: v)? v?3(?: 0)?", NAME),
    ("gpl-2", ("gplv2",), "gplv2", NAME),
    ("gpl-3", ("gplv3",), "gplv3", NAME),
    ("lgpl", ("lgpl",), "(?:gnu )?lgpl(?: v)?(?: [23](?: [01])?)?", NAME),
    ("lgpl-2.1", ("lgplv2",), "lgplv2 1", NAME),
    ("lgpl-3", ("lgplv3",), "lgplv3", NAME),
    ("agpl-3", ("agpl",), "(?:gnu )?agpl(?: v)?(?: 3(?: 0)?)?", NAME),
    ("agpl-3", ("agplv3",), "agplv3", NAME),
    ("mpl-2", ("source", "mozilla", "mpl"), "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file", TEXT),
    ("mpl-2", ("mpl",), "mpl 2(?: 0)?", NAME),
    ("epl-1", ("accompanying", "eclipse"), "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", TEXT),
    ("epl-2", ("accompanying", "eclipse"), "this program and the accompanying materials are made available under the terms of the eclipse public license(?: v)? 2 0", TEXT),
    ("zlib", ("warranty", "damages", "authors"), "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages", TEXT),
    ("zlib", ("altered", "misrepresented"), "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", TEXT),
    ("boost-1", ("machine", "executable"), "unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor", TEXT),
    ("unlicense", ("unencumbered",), "this is free and unencumbered software released into the public domain", TEXT),
    ("wtfpl", ("fuck",), "do what the fuck you want to(?: public license)?", TEXT),
    ("json", ("evil",), "the software shall be used for good not evil", TEXT),
    ("beerware", ("beer",), "if we meet some day and you think this stuff is worth it you can buy me a beer in return", TEXT),
    ("cc0", ("waived",), "has waived all copyright and related or neighboring rights", TEXT),
    ("cc0", ("zero", "commons"), "creative commons zero(?: v1 0)?(?: universal)?", NAME),
    ("cc-by", ("creative", "attribution"), "creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: license)?", NAME),
    ("cc-by-sa", ("creative", "attribution"), "creative commons attribution share(?: )?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: license)?", NAME),
    ("cc-by-nd", ("creative", "attribution"), "creative commons attribution no(?: )?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported| generic)?(?: license)?", NAME),
    ("cc-by-nc", ("creative", "attribution"), "creative commons attribution non(?: )?commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: license)?", NAME),
    ("cc-by-nc-sa", ("creative", "attribution"), "creative commons attribution non(?: )?commercial share(?: )?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: license)?", NAME),
    ("cc-by-nc-nd", ("creative", "attribution"), "creative commons attribution non(?: )?commercial no(?: )?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported| generic)?(?: license)?", NAME),
    ("cc-by", ("creativecommons",), "creativecommons org licenses by(?: [1-4] [05])?", GRANT),
    ("cc-by-sa", ("creativecommons",), "creativecommons org licenses by sa(?: [1-4] [05])?", GRANT),
    ("cc-by-nd", ("creativecommons",), "creativecommons org licenses by nd(?: [1-4] [05])?", GRANT),
    ("cc-by-nc", ("creativecommons",), "creativecommons org licenses by nc(?: [1-4] [05])?", GRANT),
    ("cc-by-nc-sa", ("creativecommons",), "creativecommons org licenses by nc sa(?: [1-4] [05])?", GRANT),
    ("cc-by-nc-nd", ("creativecommons",), "creativecommons org licenses by nc nd(?: [1-4] [05])?", GRANT),
    ("cc0", ("creativecommons", "zero"), "creativecommons org publicdomain zero(?: 1 0)?", GRANT),
    ("public-domain", ("domain",), "(?:placed|released|dedicated)(?: in| into| to)? the public domain", GRANT),
    ("public-domain", ("domain",), "public domain", CLUE),
    ("proprietary", ("reserved",), "all rights reserved", CLUE),
    ("proprietary", ("confidential", "proprietary"), "confidential and proprietary", CLUE),
    ("proprietary", ("unauthorized",), "unauthorized (?:copying|use|reproduction|distribution)(?: of this (?:file|work|software))?(?: via any medium)? is strictly prohibited", GRANT),
    ("noncommercial", ("commercial",), "non commercial use only", CLUE),
    ("noncommercial", ("noncommercial",), "noncommercial use only", CLUE),
    ("free-unclear", ("free", "warranty"), "free software(?: and)? comes with(?: absolutely)? no warranty", CLUE),
    ("unknown-license", ("license",), "(?:see|read) the(?: file)? license(?: file)?(?: for (?:details|more information))?", CLUE),
    ("unknown-license", ("licensed",), "licensed under(?: the)? [^ ]+ licen[sc]e", CLUE),
]

_GRANTED = "(?:licensed|released|distributed|available|published|provided|covered|redistributed|shared)"


def signature_rules() -> list[Rule]:
    """All rules in their order: sentences, then for each named licence its grant, its SPDX tag and its name."""
    rules = [Rule(*x) for x in SENTENCES]
    for label, keyword, name, spdx in NAMED:
        rules.append(Rule(label, (keyword, "under"), f"{_GRANTED} under(?: the)?(?: terms(?: and conditions)? of(?: the)?)? {name}", GRANT))
        rules.append(Rule(label, ("spdx", spdx.split()[0]), f"spdx license identifier {spdx}(?: only| or later)?", GRANT))
        rules.append(Rule(label, (keyword,), name, NAME))
    return rules
