"""Hand-written license rules over normalised words.

A text is reduced to its words (see ``licenses``), joined by single spaces: "Apache-2.0" reads ``apache 2 0`` and
"http://www.apache.org/licenses/LICENSE-2.0" reads ``http www apache org licenses license 2 0``. A rule is
(priority, label, keyword, pattern); its pattern must begin and end at word borders, and is only tried on texts
that hold the keyword. Priorities: 3 notices, addresses and machine-readable tags; 2 names with a version; 1 names
without one and loose hints.
"""

from __future__ import annotations

_V = "(?: version| v)?"  # before a version number
_LIC = "licen[cs]e"


def _family(label: str, keyword: str, *patterns: str, priority: int = 2) -> list[tuple[int, str, str, str]]:
    return [(priority, label, keyword, p) for p in patterns]


def _tag(label: str, words: str) -> list[tuple[int, str, str, str]]:
    """The machine-readable tag and the same identifier behind a "license" key."""
    return [
        (3, label, "spdx", rf"spdx {_LIC} identifier {words}"),
        (3, label, words.split()[0], rf"{_LIC} (?:id |identifier |type |expression )?{words}"),
    ]


RULES: list[tuple[int, str, str, str]] = [
    # Apache
    *_tag("apache-2.0", "apache 2 0"),
    *_family("apache-2.0", "apache", rf"licensed under (?:the )?apache {_LIC}{_V} 2(?: 0)?", rf"apache software foundation asf under one or more contributor {_LIC} agreements", r"(?:https? )?(?:www )?apache org licenses license 2 0(?: html| txt)?", rf"apache {_LIC}{_V} 2 0 january 2004", priority=3),
    *_family("apache-2.0", "apache", rf"apache(?: software)? {_LIC}{_V} 2(?: 0)?", r"apache 2(?: 0)?", r"asl 2(?: 0)?"),
    *_family("apache-1.1", "apache", rf"apache(?: software)? {_LIC}{_V} 1 1", r"apache 1 1"),
    *_family("apache-1.0", "apache", rf"apache(?: software)? {_LIC}{_V} 1 0", r"apache 1 0"),
    *_family("apache", "apache", rf"licensed under (?:the )?apache {_LIC}", rf"apache(?: software)? {_LIC}", priority=1),
    # MIT and its kin
    *_tag("mit", "mit"),
    *_family("mit", "mit", rf"licensed under (?:the )?(?:terms of (?:the )?)?mit {_LIC}", r"(?:https? )?(?:www )?opensource org licenses? mit(?: license)?(?: php| html)?", rf"released under (?:the )?mit {_LIC}", rf"distributed under (?:the )?(?:terms of (?:the )?)?mit {_LIC}", priority=3),
    *_family("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy", r"permission is hereby granted free of charge to any person", priority=3),
    *_family("mit", "mit", rf"the mit {_LIC}(?: mit)?", rf"mit {_LIC}", r"mit x11", rf"mit style {_LIC}"),
    *_family("mit-0", "mit", rf"mit no attribution(?: {_LIC})?", r"mit 0"),
    *_family("x11", "x11", rf"x11 {_LIC}", r"x consortium"),
    *_family("expat", "expat", rf"expat {_LIC}"),
    *_family("isc", "isc", rf"licensed under (?:the )?isc {_LIC}", rf"isc {_LIC}"),
    *_family("isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted", priority=3),
    *_tag("isc", "isc"),
    *_family("bsl-1.0", "boost", rf"boost software {_LIC}{_V} 1(?: 0)?", r"(?:https? )?(?:www )?boost org license 1 0 txt", rf"boost software {_LIC}"),
    *_tag("bsl-1.0", "bsl 1 0"),
    # BSD
    *_tag("bsd-2-clause", "bsd 2 clause"),
    *_tag("bsd-3-clause", "bsd 3 clause"),
    *_family("bsd-2-clause", "bsd", rf"(?:simplified|freebsd|2 clause) bsd(?: {_LIC})?", rf"bsd 2 clause(?: {_LIC})?", r"(?:https? )?(?:www )?opensource org licenses? bsd 2 clause"),
    *_family("bsd-3-clause", "bsd", rf"(?:new|revised|modified|3 clause) bsd(?: {_LIC})?", rf"bsd 3 clause(?: {_LIC})?", r"(?:https? )?(?:www )?opensource org licenses? bsd 3 clause"),
    *_family("bsd-4-clause", "bsd", rf"(?:original|old|4 clause) bsd(?: {_LIC})?", rf"bsd 4 clause(?: {_LIC})?"),
    *_family("0bsd", "bsd", r"0bsd", rf"zero clause bsd(?: {_LIC})?", rf"bsd zero clause(?: {_LIC})?"),
    *_family("bsd", "bsd", rf"licensed under (?:the |a )?bsd {_LIC}", rf"bsd {_LIC}", rf"bsd style {_LIC}", r"berkeley software distribution", priority=1),
    *_family("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted", r"redistributions of source code must retain the above copyright notice", r"redistributions in binary form must reproduce the above copyright notice", priority=3),
    *_family("bsd-3-clause", "neither the name", r"neither the name of (?:the )?(?:[^ ]+ ){1,8}nor the names of (?:its|the) contributors may be used to endorse", priority=3),
    # GNU
    *_tag("gpl-2.0", "gpl 2 0"),
    *_tag("gpl-3.0", "gpl 3 0"),
    *_tag("lgpl-2.1", "lgpl 2 1"),
    *_tag("lgpl-3.0", "lgpl 3 0"),
    *_tag("agpl-3.0", "agpl 3 0"),
    *_family("gpl-2.0", "general public", rf"gnu general public {_LIC}(?: as published by the free software foundation)?(?: either)?{_V} 2(?: 0)?(?: only)?", rf"general public {_LIC}{_V} 2(?: 0)?"),
    *_family("gpl-2.0-or-later", "general public", rf"gnu general public {_LIC}(?: as published by the free software foundation)?(?: either)?{_V} 2(?: 0)?(?: of the license)? or at your option any later version", rf"(?:gnu )?general public {_LIC}{_V} 2(?: 0)? or (?:any )?later", priority=3),
    *_family("gpl-3.0", "general public", rf"gnu general public {_LIC}(?: as published by the free software foundation)?(?: either)?{_V} 3(?: 0)?(?: only)?", rf"general public {_LIC}{_V} 3(?: 0)?"),
    *_family("gpl-3.0-or-later", "general public", rf"gnu general public {_LIC}(?: as published by the free software foundation)?(?: either)?{_V} 3(?: 0)?(?: of the license)? or at your option any later version", rf"(?:gnu )?general public {_LIC}{_V} 3(?: 0)? or (?:any )?later", priority=3),
    *_family("gpl-2.0", "gpl", r"gnu gpl(?: version| v)? ?2(?: 0)?", r"gpl(?: version| v)? 2(?: 0)?", r"gplv2"),
    *_family("gpl-2.0-or-later", "gpl", r"gpl 2(?: 0)? or later", r"gplv2 or later"),
    *_family("gpl-3.0", "gpl", r"gnu gpl(?: version| v)? ?3(?: 0)?", r"gpl(?: version| v)? 3(?: 0)?", r"gplv3"),
    *_family("gpl-3.0-or-later", "gpl", r"gpl 3(?: 0)? or later", r"gplv3 or later"),
    *_family("gpl", "gnu org", r"(?:https? )?(?:www )?gnu org licenses gpl(?: 2 0| 3 0)?(?: html| txt)?", r"(?:https? )?(?:www )?gnu org copyleft gpl html", priority=3),
    *_family("gpl", "general public", rf"gnu general public {_LIC}", rf"licensed under (?:the )?(?:gnu )?general public {_LIC}", priority=1),
    *_family("gpl", "gpl", rf"licensed under (?:the )?(?:gnu )?gpl", r"gnu gpl", priority=1),
    *_family("lgpl-2.1", "lesser general", rf"gnu lesser general public {_LIC}{_V} 2 1", rf"lesser general public {_LIC}{_V} 2 1"),
    *_family("lgpl-3.0", "lesser general", rf"gnu lesser general public {_LIC}{_V} 3(?: 0)?", rf"lesser general public {_LIC}{_V} 3(?: 0)?"),
    *_family("lgpl-2.0", "library general", rf"gnu library general public {_LIC}{_V} 2(?: 0)?", rf"library general public {_LIC}"),
    *_family("lgpl", "lesser general", rf"gnu lesser general public {_LIC}", rf"lesser general public {_LIC}", priority=1),
    *_family("lgpl-2.1", "lgpl", r"lgpl(?: version| v)? 2 1", r"lgplv2 1"),
    *_family("lgpl-3.0", "lgpl", r"lgpl(?: version| v)? 3(?: 0)?", r"lgplv3"),
    *_family("lgpl", "lgpl", r"gnu lgpl", rf"licensed under (?:the )?lgpl", priority=1),
    *_family("agpl-3.0", "affero", rf"gnu affero general public {_LIC}{_V} 3(?: 0)?", rf"affero general public {_LIC}{_V} 3(?: 0)?"),
    *_family("agpl", "affero", rf"gnu affero general public {_LIC}", rf"affero general public {_LIC}", priority=1),
    *_family("agpl-3.0", "agpl", r"agpl(?: version| v)? 3(?: 0)?", r"agplv3"),
    *_family("gfdl-1.3", "free documentation", rf"gnu free documentation {_LIC}{_V} 1 3"),
    *_family("gfdl-1.2", "free documentation", rf"gnu free documentation {_LIC}{_V} 1 2"),
    *_family("gfdl", "free documentation", rf"gnu free documentation {_LIC}", rf"free documentation {_LIC}", priority=1),
    *_family("gpl", "free software", r"this program is free software you can redistribute it and or modify it", r"free software foundation inc (?:51 franklin|59 temple)", priority=1),
    # Creative Commons
    *_tag("cc-by-4.0", "cc by 4 0"),
    *_tag("cc-by-sa-4.0", "cc by sa 4 0"),
    *_tag("cc0-1.0", "cc0 1 0"),
    *_family("cc-by-4.0", "cc by", rf"cc by(?: {_LIC})?{_V} 4 0", r"cc by 4(?: 0)?(?: international)?"),
    *_family("cc-by-3.0", "cc by", r"cc by 3 0(?: unported)?"),
    *_family("cc-by-2.0", "cc by", r"cc by 2 0(?: generic)?"),
    *_family("cc-by-2.5", "cc by", r"cc by 2 5"),
    *_family("cc-by-sa-4.0", "cc by sa", r"cc by sa 4 0(?: international)?"),
    *_family("cc-by-sa-3.0", "cc by sa", r"cc by sa 3 0(?: unported)?"),
    *_family("cc-by-sa", "cc by sa", r"cc by sa", priority=1),
    *_family("cc-by-nd-4.0", "cc by nd", r"cc by nd 4 0(?: international)?"),
    *_family("cc-by-nd", "cc by nd", r"cc by nd", priority=1),
    *_family("cc-by-nc-4.0", "cc by nc", r"cc by nc 4 0(?: international)?"),
    *_family("cc-by-nc", "cc by nc", r"cc by nc", priority=1),
    *_family("cc-by-nc-sa-4.0", "cc by nc sa", r"cc by nc sa 4 0(?: international)?"),
    *_family("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa", priority=2),
    *_family("cc-by-nc-nd-4.0", "cc by nc nd", r"cc by nc nd 4 0(?: international)?"),
    *_family("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd", priority=2),
    *_family("cc-by-4.0", "creative commons", rf"creative commons attribution 4 0(?: international)?(?: {_LIC})?", rf"licensed under (?:a |the )?creative commons attribution 4 0(?: international)?(?: {_LIC})?", priority=3),
    *_family("cc-by-3.0", "creative commons", rf"creative commons attribution 3 0(?: unported)?(?: {_LIC})?"),
    *_family("cc-by-sa-4.0", "creative commons", rf"creative commons attribution share ?alike 4 0(?: international)?(?: {_LIC})?", priority=3),
    *_family("cc-by-sa-3.0", "creative commons", rf"creative commons attribution share ?alike 3 0(?: unported)?(?: {_LIC})?", priority=3),
    *_family("cc-by-nc-4.0", "creative commons", rf"creative commons attribution non ?commercial 4 0(?: international)?(?: {_LIC})?", priority=3),
    *_family("cc-by-nd-4.0", "creative commons", rf"creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?(?: {_LIC})?", priority=3),
    *_family("cc-by-nc-sa-4.0", "creative commons", rf"creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: {_LIC})?", priority=3),
    *_family("cc-by-nc-nd-4.0", "creative commons", rf"creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?(?: {_LIC})?", priority=3),
    *_family("cc-by", "creative commons", rf"creative commons attribution(?: {_LIC})?", priority=1),
    *_family("cc-by-sa", "creative commons", rf"creative commons attribution share ?alike(?: {_LIC})?", priority=2),
    *_family("cc-by-nc", "creative commons", rf"creative commons attribution non ?commercial(?: {_LIC})?", priority=2),
    *_family("cc", "creative commons", rf"creative commons {_LIC}", r"creative commons", priority=1),
    *_family("cc-by-4.0", "creativecommons", r"(?:https? )?(?:www )?creativecommons org licenses by 4 0", priority=3),
    *_family("cc-by-3.0", "creativecommons", r"(?:https? )?(?:www )?creativecommons org licenses by 3 0", priority=3),
    *_family("cc-by-sa-4.0", "creativecommons", r"(?:https? )?(?:www )?creativecommons org licenses by sa 4 0", priority=3),
    *_family("cc-by-sa-3.0", "creativecommons", r"(?:https? )?(?:www )?creativecommons org licenses by sa 3 0", priority=3),
    *_family("cc-by-nc-4.0", "creativecommons", r"(?:https? )?(?:www )?creativecommons org licenses by nc 4 0", priority=3),
    *_family("cc-by-nd-4.0", "creativecommons", r"(?:https? )?(?:www )?creativecommons org licenses by nd 4 0", priority=3),
    *_family("cc-by-nc-sa-4.0", "creativecommons", r"(?:https? )?(?:www )?creativecommons org licenses by nc sa 4 0", priority=3),
    *_family("cc-by-nc-nd-4.0", "creativecommons", r"(?:https? )?(?:www )?creativecommons org licenses by nc nd 4 0", priority=3),
    *_family("cc0-1.0", "creativecommons", r"(?:https? )?(?:www )?creativecommons org publicdomain zero 1 0", priority=3),
    *_family("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", rf"creative commons zero(?: 1 0)?"),
    *_family("cc-pdm", "publicdomain", r"creativecommons org publicdomain mark 1 0", priority=3),
    # Mozilla, Eclipse and other weak copyleft
    *_tag("mpl-2.0", "mpl 2 0"),
    *_tag("epl-2.0", "epl 2 0"),
    *_family("mpl-2.0", "mozilla", rf"mozilla public {_LIC}{_V} 2(?: 0)?", r"(?:https? )?(?:www )?mozilla org mpl 2 0", rf"subject to the terms of the mozilla public {_LIC}{_V} 2 0"),
    *_family("mpl-1.1", "mozilla", rf"mozilla public {_LIC}{_V} 1 1", r"(?:https? )?(?:www )?mozilla org mpl 1 1"),
    *_family("mpl-1.0", "mozilla", rf"mozilla public {_LIC}{_V} 1 0"),
    *_family("mpl", "mozilla", rf"mozilla public {_LIC}", r"(?:https? )?(?:www )?mozilla org mpl", priority=1),
    *_family("mpl-2.0", "mpl", r"mpl(?: v)? 2 0", r"mplv2"),
    *_family("epl-1.0", "eclipse", rf"eclipse public {_LIC}{_V} 1 0", r"eclipse org legal epl v10(?: html)?"),
    *_family("epl-2.0", "eclipse", rf"eclipse public {_LIC}{_V} 2(?: 0)?", r"eclipse org legal epl 2 0"),
    *_family("epl", "eclipse", rf"eclipse public {_LIC}", priority=1),
    *_family("edl-1.0", "eclipse", rf"eclipse distribution {_LIC}{_V} 1 0"),
    *_family("cddl-1.0", "cddl", rf"cddl(?: version)? 1 0"),
    *_family("cddl-1.1", "cddl", rf"cddl(?: version)? 1 1"),
    *_family("cddl-1.0", "common development", rf"common development and distribution {_LIC}{_V} 1 0"),
    *_family("cddl", "common development", rf"common development and distribution {_LIC}", priority=1),
    *_family("cpl-1.0", "common public", rf"common public {_LIC}{_V} 1 0"),
    *_family("cpl", "common public", rf"common public {_LIC}", priority=1),
    *_family("cpal-1.0", "common public attribution", rf"common public attribution {_LIC}(?:{_V} 1 0)?"),
    *_family("ipl-1.0", "ibm public", rf"ibm public {_LIC}(?:{_V} 1 0)?"),
    *_family("osl-3.0", "open software", rf"open software {_LIC}{_V} 3 0"),
    *_family("osl", "open software", rf"open software {_LIC}", priority=1),
    *_family("afl-3.0", "academic free", rf"academic free {_LIC}{_V} 3 0"),
    *_family("afl", "academic free", rf"academic free {_LIC}", priority=1),
    *_family("eupl-1.2", "european union public", rf"european union public {_LIC}{_V} 1 2"),
    *_family("eupl-1.1", "european union public", rf"european union public {_LIC}{_V} 1 1"),
    *_family("eupl", "european union public", rf"european union public {_LIC}", priority=1),
    *_family("eupl-1.2", "eupl", r"eupl(?: v)? 1 2"),
    *_family("cecill-2.1", "cecill", r"cecill(?: version| v)? 2 1"),
    *_family("cecill-b", "cecill", rf"cecill b(?: {_LIC})?"),
    *_family("cecill-c", "cecill", rf"cecill c(?: {_LIC})?"),
    *_family("cecill", "cecill", rf"cecill {_LIC}", r"licence cecill", priority=1),
    *_family("apsl-2.0", "apple public", rf"apple public source {_LIC}{_V} 2 0"),
    *_family("apsl", "apple public", rf"apple public source {_LIC}", priority=1),
    *_family("ms-pl", "microsoft", rf"microsoft public {_LIC}(?: ms pl)?"),
    *_family("ms-rl", "microsoft", rf"microsoft reciprocal {_LIC}(?: ms rl)?"),
    *_family("sissl", "sun industry", rf"sun industry standards source {_LIC}"),
    *_family("spl-1.0", "sun public", rf"sun public {_LIC}(?:{_V} 1 0)?"),
    *_family("npl-1.1", "netscape", rf"netscape public {_LIC}(?:{_V} 1 1)?"),
    *_family("qpl-1.0", "q public", rf"q public {_LIC}(?:{_V} 1 0)?"),
    *_family("lppl-1.3c", "latex project", rf"latex project public {_LIC}{_V} 1 3c?"),
    *_family("lppl", "latex project", rf"latex project public {_LIC}", priority=1),
    *_family("artistic-2.0", "artistic", rf"(?:the )?artistic {_LIC}{_V} 2(?: 0)?", r"artistic 2 0"),
    *_family("artistic-1.0", "artistic", rf"(?:the )?artistic {_LIC}{_V} 1(?: 0)?"),
    *_family("artistic", "artistic", rf"(?:the )?artistic {_LIC}", priority=1),
    *_family("perl", "perl", r"(?:under )?the same terms as perl(?: itself)?", rf"perl {_LIC}"),
    *_family("ruby", "ruby", rf"ruby {_LIC}", r"(?:under )?the same terms as ruby(?: itself)?"),
    *_family("php-3.01", "php", rf"php {_LIC}{_V} 3 01"),
    *_family("php-3.0", "php", rf"php {_LIC}{_V} 3 0"),
    *_family("php", "php", rf"(?:the )?php {_LIC}", priority=1),
    *_family("psf-2.0", "python software", rf"python software foundation {_LIC}(?:{_V} 2(?: 0)?)?"),
    *_family("python-2.0", "python", rf"python {_LIC}{_V} 2(?: 0)?"),
    *_family("python", "python", rf"python {_LIC}", priority=1),
    *_family("zlib", "zlib", rf"zlib libpng {_LIC}", rf"zlib {_LIC}"),
    *_family("zlib", "as is without any express", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", priority=3),
    *_family("libpng", "libpng", rf"libpng {_LIC}(?:{_V} 2)?"),
    *_family("openssl", "openssl", rf"openssl {_LIC}", r"openssl project for use in the openssl toolkit"),
    *_family("ncsa", "ncsa", rf"ncsa open source {_LIC}", rf"university of illinois(?: ncsa)? open source {_LIC}"),
    *_family("unicode", "unicode", rf"unicode {_LIC} agreement", rf"unicode {_LIC}"),
    *_family("icu", "icu", rf"icu {_LIC}"),
    *_family("w3c", "w3c", rf"w3c software(?: notice and)? {_LIC}", rf"w3c {_LIC}", rf"w3c document {_LIC}"),
    *_family("curl", "curl", rf"curl {_LIC}"),
    *_family("postgresql", "postgresql", rf"postgresql {_LIC}"),
    *_family("vim", "vim", rf"vim {_LIC}"),
    *_family("tcl", "tcl", rf"tcl tk {_LIC}", rf"tcl {_LIC}"),
    *_family("sleepycat", "sleepycat", rf"sleepycat {_LIC}", r"sleepycat software"),
    *_family("wtfpl", "wtfpl", r"wtfpl(?: version| v)?(?: 2)?"),
    *_family("wtfpl", "do what the", rf"do what the f[^ ]{{1,3}} you want to public {_LIC}"),
    *_family("beerware", "beer", rf"the beer ?ware {_LIC}", rf"beerware {_LIC}"),
    *_family("unlicense", "unlicense", r"(?:https? )?(?:www )?unlicense org", r"the unlicense", r"spdx license identifier unlicense"),
    *_family("unlicense", "public domain", r"this is free and unencumbered software released into the public domain", priority=3),
    *_family("public-domain", "public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", r"(?:is|are) in the public domain", r"public domain dedication", r"public domain work"),
    *_family("public-domain", "public domain", r"public domain", priority=1),
    *_family("pddl-1.0", "open data commons", rf"open data commons public domain dedication(?: and {_LIC})?", r"opendatacommons org licenses pddl"),
    *_family("odbl-1.0", "open database", rf"open(?: data commons open)? database {_LIC}(?:{_V} 1 0)?", r"odbl 1 0"),
    *_family("odc-by-1.0", "open data commons", rf"open data commons attribution {_LIC}(?:{_V} 1 0)?"),
    *_family("ogl-uk-3.0", "open government", rf"open government {_LIC}{_V} 3 0"),
    *_family("ogl", "open government", rf"open government {_LIC}", priority=1),
    *_family("ofl-1.1", "open font", rf"sil open font {_LIC}(?:{_V} 1 1)?", rf"open font {_LIC}"),
    *_family("ofl-1.1", "ofl", r"scripts sil org ofl", r"ofl 1 1"),
    *_family("openrail", "rail", rf"open ?rail(?: m)? {_LIC}", rf"bigscience rail {_LIC}", rf"responsible ai {_LIC}"),
    # restrictive and source-available
    *_family("sspl-1.0", "server side", rf"server side public {_LIC}(?:{_V} 1)?"),
    *_family("busl-1.1", "business source", rf"business source {_LIC}(?:{_V} 1 1)?"),
    *_family("elastic-2.0", "elastic", rf"elastic {_LIC}(?:{_V} 2(?: 0)?)?"),
    *_family("commons-clause", "commons clause", rf"commons clause(?: {_LIC})?(?: condition)?"),
    *_family("polyform", "polyform", rf"polyform (?:noncommercial|small business|shield|strict|perimeter) {_LIC}"),
    *_family("proprietary", "proprietary", r"proprietary and confidential", r"unauthorized copying of this file via any medium is strictly prohibited", rf"proprietary {_LIC}"),
    *_family("proprietary", "confidential", r"confidential and proprietary", r"trade secret and confidential"),
    *_family("eula", "end user", rf"end user {_LIC} agreement", r"by installing this software you agree"),
    *_family("no-redistribution", "may not be", r"may not be (?:copied|reproduced|redistributed|republished)(?: or (?:copied|reproduced|distributed|transmitted))?(?: in any form)? without (?:prior |express |the )?(?:written )?permission"),
    *_family("no-redistribution", "no part of this", r"no part of this (?:publication|book|document|work) may be reproduced", priority=3),
    *_family("non-commercial", "non commercial", r"for non commercial (?:use|purposes) only", r"non commercial use only"),
    *_family("personal-use", "personal use", r"for personal use only"),
    *_family("reserved", "rights reserved", r"copyright (?:c )?[0-9]{4}(?: [0-9]{4})?(?: [^ ]+){1,6} all rights reserved", priority=3),
    *_family("some-rights", "rights reserved", r"some rights reserved"),
    *_family("no-rights", "rights reserved", r"no rights reserved"),
    *_family("copyright", "copyright", r"copyright (?:c )?[0-9]{4}(?: [0-9]{4})?(?: (?:by )?[^ ]+)?", r"copyright c [^ ]+", r"copyright holders?", priority=1),
    # hints without a name
    *_family("license-file", "licen", rf"see (?:the )?(?:accompanying )?{_LIC}(?: txt| md)?(?: file)? for (?:more |further )?(?:details|information|terms)", rf"{_LIC} file in the root directory", priority=1),
    *_family("as-is", "as is", rf"distributed on an as is basis without warranties or conditions of any kind", rf"provided as is without warranty of any kind", priority=1),
    *_family("free-software", "free software", r"is free software", priority=1),
    *_family("open-source", "open source", rf"(?:released|licensed|available) under an open source {_LIC}", rf"open source {_LIC}", priority=1),
]

#: (phrase, label): found wherever the words stand one after the other; never suppressed.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
