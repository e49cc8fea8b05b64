"""License scans: ordered signature rules.

A rule is a regular expression over the words of a text (lower-cased A-Z; digits, letters and non-ASCII characters), a label,
a priority and a keyword. Rules are sentence forms (:data:`FORMS`) filled with the names of licenses (:data:`LICENSES`), and
sentences of the licenses themselves, which need no name (:data:`SIGNATURES`). A
text is searched for all keywords at once; only rules whose keyword is there are run. Of the detections, those that lie in
one of higher priority, or of equal priority and greater length, are suppressed; those that overlap one in part stay. Labels
are those of what is left, and those of the base phrases, wherever these stand.

Defined cases: null or empty text has no words, no labels and score 0; repeated rows get equal results; an empty table gives
an empty result; extra columns are kept, those named like the added ones are replaced. The score is the highest priority among the detections that are left, as a part
of 100; a base phrase alone counts ``BASE_PRIORITY``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textloom.llm.common import slices

#: The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
BASE_PRIORITY = 50

_V = r"(?: version| v)? ?v?"
_LIC = "licen[cs]e"
#: (label, keywords one of which has to be there, name): words are parted by one space.
LICENSES = [
    ("gpl-1.0", ("gpl", "general public"), rf"(?:gnu )?(?:gpl|general public {_LIC}){_V} ?1(?: 0)?"),
    ("gpl-2.0", ("gpl", "general public"), rf"(?:gnu )?(?:gpl|general public {_LIC}){_V} ?2(?: 0)?"),
    ("gpl-3.0", ("gpl", "general public"), rf"(?:gnu )?(?:gpl|general public {_LIC}){_V} ?3(?: 0)?"),
    ("gpl", ("gpl", "general public"), rf"gnu (?:gpl|general public {_LIC})"),
    ("lgpl-2.0", ("lgpl", "library general"), rf"(?:gnu )?(?:lgpl|library general public {_LIC}){_V} ?2(?: 0)?"),
    ("lgpl-2.1", ("lgpl", "lesser general"), rf"(?:gnu )?(?:lgpl|lesser general public {_LIC}){_V} ?2 1"),
    ("lgpl-3.0", ("lgpl", "lesser general"), rf"(?:gnu )?(?:lgpl|lesser general public {_LIC}){_V} ?3(?: 0)?"),
    ("lgpl", ("lgpl", "lesser general"), rf"(?:gnu )?(?:lgpl|lesser general public {_LIC})"),
    ("agpl-3.0", ("agpl", "affero"), rf"(?:gnu )?(?:agpl|affero general public {_LIC}){_V} ?3(?: 0)?"),
    ("agpl", ("agpl", "affero"), rf"(?:gnu )?(?:agpl|affero general public {_LIC})"),
    ("gfdl-1.2", ("gfdl", "free documentation"), rf"(?:gnu )?(?:gfdl|free documentation {_LIC}){_V} ?1 2"),
    ("gfdl-1.3", ("gfdl", "free documentation"), rf"(?:gnu )?(?:gfdl|free documentation {_LIC}){_V} ?1 3"),
    ("gfdl", ("gfdl", "free documentation"), rf"(?:gnu )?(?:gfdl|free documentation {_LIC})"),
    ("apache-1.1", ("apache",), rf"apache(?: software)?(?: {_LIC})?{_V} ?1 1"),
    ("apache-2.0", ("apache",), rf"apache(?: software)?(?: {_LIC})?{_V} ?2(?: 0)?"),
    ("apache", ("apache",), rf"apache(?: software)? {_LIC}"),
    ("mit", (" mit ",), rf"(?:mit|expat|mit expat|mit x11) {_LIC}"),
    ("x11", ("x11",), rf"x11 {_LIC}"),
    ("isc", (" isc ",), rf"isc {_LIC}"),
    ("bsd-2-clause", ("bsd",), rf"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: {_LIC})?"),
    ("bsd-3-clause", ("bsd",), rf"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: {_LIC})?"),
    ("bsd-4-clause", ("bsd",), rf"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: {_LIC})?"),
    ("0bsd", ("bsd",), rf"(?:0bsd|zero clause bsd)(?: {_LIC})?"),
    ("bsd", ("bsd",), rf"(?:bsd|bsd style|berkeley software distribution) {_LIC}"),
    ("mpl-1.0", ("mpl", "mozilla"), rf"(?:mpl|mozilla public {_LIC}){_V} ?1 0"),
    ("mpl-1.1", ("mpl", "mozilla"), rf"(?:mpl|mozilla public {_LIC}){_V} ?1 1"),
    ("mpl-2.0", ("mpl", "mozilla"), rf"(?:mpl|mozilla public {_LIC}){_V} ?2(?: 0)?"),
    ("mpl", ("mozilla",), rf"mozilla public {_LIC}"),
    ("epl-1.0", ("epl", "eclipse"), rf"(?:epl|eclipse public {_LIC}){_V} ?1 0"),
    ("epl-2.0", ("epl", "eclipse"), rf"(?:epl|eclipse public {_LIC}){_V} ?2(?: 0)?"),
    ("epl", ("eclipse",), rf"eclipse public {_LIC}"),
    ("cddl-1.0", ("cddl", "common development"), rf"(?:cddl|common development and distribution {_LIC})(?:{_V} ?1(?: 0)?)?"),
    ("cpl-1.0", ("common public",), rf"common public {_LIC}(?:{_V} ?1(?: 0)?)?"),
    ("eupl-1.1", ("eupl", "european union public"), rf"(?:eupl|european union public {_LIC}){_V} ?1 1"),
    ("eupl-1.2", ("eupl", "european union public"), rf"(?:eupl|european union public {_LIC}){_V} ?1 2"),
    ("eupl", ("eupl", "european union public"), rf"(?:eupl|european union public {_LIC})"),
    ("artistic-1.0", ("artistic",), rf"artistic {_LIC}{_V} ?1(?: 0)?"),
    ("artistic-2.0", ("artistic",), rf"artistic {_LIC}{_V} ?2(?: 0)?"),
    ("artistic", ("artistic",), rf"artistic {_LIC}"),
    ("bsl-1.0", ("boost",), rf"boost software {_LIC}(?:{_V} ?1(?: 0)?)?"),
    ("busl-1.1", ("business source",), rf"business source {_LIC}(?:{_V} ?1 1)?"),
    ("sspl-1.0", ("sspl", "server side public"), rf"(?:sspl|server side public {_LIC})(?:{_V} ?1(?: 0)?)?"),
    ("elastic-2.0", ("elastic",), rf"elastic {_LIC}(?:{_V} ?2(?: 0)?)?"),
    ("psf-2.0", ("psf", "python software"), rf"(?:psf|python software foundation) {_LIC}(?:{_V} ?2(?: 0)?)?"),
    ("php-3.01", (" php ",), rf"php {_LIC}{_V} ?3 01"),
    ("php", (" php ",), rf"php {_LIC}"),
    ("ruby", ("ruby",), rf"ruby {_LIC}"),
    ("zlib", ("zlib",), rf"(?:zlib|zlib libpng|libpng) {_LIC}"),
    ("wtfpl", ("wtfpl", "what the"), rf"(?:wtfpl|do what the fuck you want to public {_LIC})"),
    ("unlicense", ("unlicense",), "(?:the )?unlicense"),
    ("postgresql", ("postgresql",), rf"postgresql {_LIC}"),
    ("ncsa", ("ncsa",), rf"(?:university of illinois )?ncsa(?: open source)? {_LIC}"),
    ("ofl-1.1", ("ofl", "open font"), rf"(?:sil )?(?:ofl|open font {_LIC})(?:{_V} ?1 1)?"),
    ("odbl-1.0", ("odbl", "open database"), rf"(?:odbl|open database {_LIC})(?:{_V} ?1(?: 0)?)?"),
    ("odc-by-1.0", ("open data commons",), rf"open data commons attribution {_LIC}(?:{_V} ?1(?: 0)?)?"),
    ("pddl-1.0", ("pddl", "public domain dedication"), rf"(?:pddl|public domain dedication and {_LIC})"),
    ("cc0-1.0", ("cc0", "creative commons zero"), "(?:cc0|creative commons zero)(?: 1 0)?(?: universal)?"),
    *[
        (f"cc-{kind}{end}", ("cc ", "creative commons"), rf"(?:creative commons )?(?:cc {short}|creative commons {long})(?: {_LIC})?{version}")
        for kind, short, long in (
            ("by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative|atives|s)(?: works)?"), ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
            ("by-nc", "by nc", "attribution non ?commercial"), ("by-nd", "by nd", "attribution no ?deriv(?:ative|atives|s)(?: works)?"), ("by-sa", "by sa", "attribution share ?alike"), ("by", "by", "attribution"),
        )
        for end, version in (("-2.0", " 2 0"), ("-2.5", " 2 5"), ("-3.0", " 3 0"), ("-4.0", " 4 0"), ("", ""))
    ],
]

#: (priority, sentence around a license's name).
FORMS = [
    (100, r"spdx license identifier {name}(?: only| or later| with [a-z0-9]+ exception)?"),
    (95, rf"(?:is |are |be )?(?:dual |re )?{_LIC}d (?:to you )?under (?:the )?(?:terms (?:and conditions )?of )?(?:either )?(?:the )?{{name}}(?: or (?:any )?later(?: version)?)?"),
    (90, r"(?:re)?(?:released|distributed|published|provided|shared|offered|available) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{name}"),
    (85, r"(?:subject to|governed by|covered by|in accordance with|in compliance with|compatible with) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{name}"),
    (80, rf"(?:terms|text|copy|conditions|provisions) of (?:the )?{{name}}"),
    (75, rf"{_LIC} (?:is |type )?(?:the )?{{name}}"),
    (40, "{name}"),
]
_SOME = "(?: [^ ]+)"
_ENDORSE = rf"neither the names?{_SOME}{{1,40}}? to endorse or promote products"
_UNDER = r"(?:(?:(?:is |are |be )?(?:dual |re )?[a-z]+ (?:to you )?)?under )?(?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
_BINARY = "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_NOTICE_TAIL = "(?: of the licen[cs]e)?(?: only)?(?: or at your option any later version| or any later version)?"
_ISC = "permission to use copy modify (?:and or|and|or) distribute this software for any purpose with or without fee is hereby granted"
#: (label, priority, keyword, sentence): grants, conditions, disclaimers and notices.
SIGNATURES = [
    *[
        (f"{label}-{version}", 98, "free software foundation", rf"{_UNDER}(?:gnu )?{name} {_LIC} as published by the free software foundation (?:either )?version {number}{_NOTICE_TAIL}")
        for label, name, versions in (
            ("gpl", "general public", (("1.0", "1(?: 0)?"), ("2.0", "2(?: 0)?"), ("3.0", "3(?: 0)?"))), ("lgpl", "library general public", (("2.0", "2(?: 0)?"),)),
            ("lgpl", "lesser general public", (("2.1", "2 1"), ("3.0", "3(?: 0)?"))), ("agpl", "affero general public", (("3.0", "3(?: 0)?"),)),
        )
        for version, number in versions
    ],
    ("mit", 96, "hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?!(?: the software)? to deal with)(?: the software)?(?: to deal in the software without restriction)?"),
    ("ncsa", 96, "hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)? to deal with the software without restriction"),
    ("bsl-1.0", 96, "hereby granted free of charge", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("ofl-1.1", 96, "hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("mit", 70, "permission notice shall be included", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", 45, "in no event shall the authors", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from"),
    ("isc", 96, "with or without fee is hereby granted", f"{_ISC} provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", 96, "with or without fee is hereby granted", f"{_ISC}(?! provided that)"),
    ("postgresql", 96, "without a written agreement", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("bsd-4-clause", 97, "advertising materials", rf"all advertising materials mentioning features or use of this software must display the following acknowledge?ment(?:{_SOME}{{0,80}}? {_ENDORSE})?"),
    ("bsd-3-clause", 96, "neither the name", _ENDORSE),
    ("bsd-2-clause", 96, "redistributions in binary form", f"{_BINARY} this software is provided by"),
    ("bsd", 70, "redistributions in binary form", _BINARY),
    ("bsd", 70, "redistribution and use in source", "redistribution and use in source and binary forms with or without modification (?:are|is) permitted provided that the following conditions are met"),
    ("bsd", 45, "this software is provided by", rf"this software is provided by{_SOME}{{1,20}}? as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("zlib", 96, "permission is granted to anyone", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("zlib", 70, "must not be misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", 45, "in no event will the authors", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("apache-2.0", 70, "unless required by applicable law", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("unlicense", 96, "free and unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", 96, "you just do what", "you just do what the fuck you want to"),
    # copyleft of the GNU family, by their bodies
    ("gpl-1.0", 60, "general public license applies to any program", "this general public license applies to any program or other work which contains a notice placed by the copyright holder saying it may be distributed under the terms of this general public license"),
    ("gpl-2.0", 60, "modified files to carry prominent notices", "you must cause the modified files to carry prominent notices stating that you changed the files and the date of any change"),
    ("gpl-2.0", 60, "derived from the program or any part thereof", "you must cause any work that you distribute or publish that in whole or in part contains or is derived from the program or any part thereof to be licensed as a whole at no charge to all third parties"),
    ("gpl-3.0", 99, "work licensed under version 3 of the gnu affero", "permission to link or combine any covered work with a work licensed under version 3 of the gnu affero general public license into a single combined work"),
    ("agpl-3.0", 99, "work licensed under version 3 of the gnu general", "permission to link or combine any covered work with a work licensed under version 3 of the gnu general public license into a single combined work"),
    ("lgpl", 60, "work that uses the library", "a program that contains no derivative of any portion of the library but is designed to work with the library by being compiled or linked with it is called a work that uses the library"),
    ("lgpl-3.0", 60, "an application is any work that makes use", "an application is any work that makes use of an interface provided by the library but which is not otherwise based on the library"),
    ("agpl-3.0", 62, "remotely through a computer network", "your modified version must prominently offer all users interacting with it remotely through a computer network"),
    ("sspl-1.0", 62, "make the functionality of the program", "if you make the functionality of the program or a modified version available to third parties as a service you must make the service source code available"),
    ("gfdl", 60, "invariant sections", "with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts"),
    ("gfdl", 60, "modified version of the document under the conditions", "you may copy and distribute a modified version of the document under the conditions of sections 2 and 3"),
    # weaker copyleft
    ("mpl-1.1", 60, "initial developer hereby grants you a world wide", "the initial developer hereby grants you a world wide royalty free non exclusive license subject to third party intellectual property claims"),
    ("mpl-2.0", 97, "source code form is subject to the terms", r"this source code form is subject to the terms of the mozilla public license v 2 0(?: if a copy of the mpl was not distributed with this file you can obtain one at(?: [^ ]+){1,6})?"),
    ("mpl-2.0", 60, "incompatible with secondary licenses", "this source code form is incompatible with secondary licenses"),
    ("mpl-2.0", 60, "distribution of covered software in source code form", "all distribution of covered software in source code form including any modifications that you create or to which you contribute must be under the terms of this license"),
    ("epl-2.0", 97, "accompanying materials are made available under the terms", r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v|version )?2 0(?: which (?:is available|accompanies)(?: [^ ]+){1,12})?"),
    ("epl-1.0", 97, "accompanying materials are made available under the terms", r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v|version )?1 0(?: which (?:is available|accompanies)(?: [^ ]+){1,12})?"),
    ("cddl-1.0", 60, "covered software", "any covered software that you distribute or otherwise make available in executable form must also be made available in source code form and that source code form must be distributed only under the terms of this license"),
    ("eupl", 60, "european union public licence", "the european union public licence applies to the work as defined below which is provided under the terms of this licence"),
    ("osl-3.0", 90, "open software license version 3 0", "licensed under the open software license version 3 0"),
    ("afl-3.0", 90, "academic free license version 3 0", "licensed under the academic free license version 3 0"),
    ("cecill-2.1", 80, "cecill", "(?:licence|license|governed by the) cecill(?: license)?(?: v| version)? ?2 1"),
    ("ms-pl", 90, "microsoft public license", "microsoft public license(?: ms pl)?"),
    ("ms-rl", 90, "microsoft reciprocal license", "microsoft reciprocal license(?: ms rl)?"),
    ("ms-rl", 60, "reciprocal grants", "reciprocal grants for any file you distribute that contains code from the software in source code or binary format you must provide recipients the source code to that file along with a copy of this license"),
    ("lppl-1.3c", 90, "latex project public license", "conditions of the latex project public license either version 1 3c? of this license or at your option any later version"),
    ("qpl-1.0", 90, "q public license", "(?:the )?q public license(?: version)?(?: 1 0)?"),
    # permissive grants
    ("apache-2.0", 60, "perpetual worldwide non exclusive no charge", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of"),
    ("apache-2.0", 60, "notice text file", "if the work includes a notice text file as part of its distribution then any derivative works that you distribute must include a readable copy of the attribution notices"),
    ("apache-2.0", 97, "you may not use this file except in compliance", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license(?: you may obtain a copy of the license at https? www apache org licenses license 2 0)?"),
    ("apache-1.1", 60, "apache software foundation", "this product includes software developed by the apache software foundation"),
    ("apache-1.1", 62, "products derived from this software may not be called apache", "products derived from this software may not be called apache nor may apache appear in their name"),
    ("mit-0", 97, "hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided as is"),
    ("x11", 72, "name of the x consortium shall not be used", "the name of the x consortium shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("json", 98, "used for good not evil", "the software shall be used for good not evil"),
    ("curl", 97, "name of a copyright holder shall not be used", "except as contained in this notice the name of a copyright holder shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("hpnd", 96, "without fee is hereby granted provided that", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted provided that the above copyright notice appear in all copies"),
    ("icu", 60, "furnished to do so provided that", "to permit persons to whom the software is furnished to do so provided that the above copyright notice s and this permission notice appear in all copies of the software"),
    ("unicode", 97, "unicode data files", "permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("unicode", 97, "data files and any associated documentation", "permission is hereby granted free of charge to any person obtaining a copy of data files and any associated documentation"),
    ("w3c", 90, "w3c", "w3c (?:software notice and license|software and document (?:notice and )?license)"),
    ("boost", 60, "machine executable object code", "unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor"),
    ("openssl", 90, "openssl project", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", 90, "cryptographic software written by eric young", "this product includes cryptographic software written by eric young"),
    ("libpng", 60, "png reference library", "the png reference library is supplied as is the contributing authors and group 42 inc disclaim all warranties"),
    ("ijg", 80, "independent jpeg group", "this software is based in part on the work of the independent jpeg group"),
    ("info-zip", 80, "info zip", "for the purposes of this copyright and license info zip is defined as the following set of individuals"),
    ("libtiff", 96, "names of sam leffler", "the names of sam leffler and silicon graphics may not be used in any advertising or publicity relating to the software"),
    ("bzip2", 74, "plainly marked as such", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software(?: 4)? the name of the author may not be used to endorse or promote products"),
    ("zlib", 72, "plainly marked as such", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("tcl", 90, "authors hereby grant permission", "the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose provided that existing copyright notices are retained in all copies"),
    ("vim", 90, "unmodified copies of vim", "there are no restrictions on distributing unmodified copies of vim"),
    ("python-2.0", 90, "python software foundation", "this license agreement is between the python software foundation psf and the individual or organization"),
    ("php-3.01", 60, "php software freely available", "this product includes php software freely available from"),
    ("ruby", 60, "make and give away verbatim copies", "you may make and give away verbatim copies of the source form of the software without restriction"),
    ("artistic-1.0", 60, "semblance of artistic control", "the copyright holder maintains some semblance of artistic control over the development of the package"),
    ("artistic-2.0", 60, "standard version", "you may distribute verbatim copies of the source form of the standard version of this package in any medium without restriction"),
    ("bsd-3-clause-clear", 98, "no express or implied licenses to any party s patent rights", "no express or implied licenses to any party s patent rights are granted by this license"),
    ("bsd-2-clause-patent", 96, "terms and conditions of this license each copyright holder and contributor", "subject to the terms and conditions of this license each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("blueoak-1.0.0", 96, "blue oak model license", "blue oak model license(?: version)?(?: 1 0 0)?"),
    ("blueoak-1.0.0", 60, "gives everyone as much permission", "this license gives everyone as much permission to work with this software as possible while protecting contributors from liability"),
    ("upl-1.0", 96, "free of charge subject to the following condition", "permission is hereby granted free of charge subject to the following conditions? to any person obtaining a copy of this software associated documentation and or data"),
    ("mulan-psl-2.0", 96, "mulan psl", "licensed under (?:the )?mulan psl v2"),
    ("mulan-psl-1.0", 96, "mulan psl", "licensed under (?:the )?mulan psl v1"),
    ("beerware", 98, "you can buy me a beer", "(?:if we meet some day and you think this stuff is worth it )?you can buy me a beer in return"),
    ("fsfap", 96, "copying and distribution of this file", "copying and distribution of this file with or without modification are permitted in any medium without royalty provided the copyright notice and this notice are preserved"),
    ("fsful", 96, "free software foundation gives unlimited permission", "the free software foundation gives unlimited permission to copy and or distribute it with or without modifications as long as this notice is preserved"),
    ("fsfullr", 98, "this file is free software", "this file is free software the free software foundation gives unlimited permission to copy and or distribute it with or without modifications as long as this notice is preserved"),
    # dedications
    ("unlicense", 70, "anyone is free to copy modify publish", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("cc0-1.0", 96, "associated a work with this deed", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights(?: to the work)?"),
    ("cc0-1.0", 96, "affirmer hereby overtly fully permanently", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders all of affirmer s copyright and related rights"),
    ("cc0-1.0", 96, "dedicated all copyright", "the authors? (?:has|have) dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
    ("public-domain", 80, "placed in the public domain", "(?:is|are|was|were|has been|have been) (?:hereby )?placed in the public domain"),
    ("public-domain", 80, "released into the public domain", "(?:is|are|was|were|has been|have been) (?:hereby )?released into the public domain"),
    ("public-domain", 75, "dedicate any and all copyright interest", "we dedicate any and all copyright interest in the software to the public domain"),
    ("sqlite-blessing", 98, "may you do good and not evil", "may you do good and not evil may you find forgiveness for yourself and forgive others may you share freely never taking more than you give"),
    # works that are not software
    ("ofl-1.1", 60, "neither the font software nor any of its individual components", "neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    ("ofl-1.1", 62, "reserved font name", "no modified version of the font software may use the reserved font name s unless explicit written permission is granted"),
    ("odbl-1.0", 60, "derivative database", "any derivative database that you publicly use must be only under the terms of this license"),
    ("cc", 55, "copy distribute and transmit the work", "you are free to share to copy distribute and transmit the work"),
    ("cc", 57, "give appropriate credit provide a link to the license", "you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-sa", 60, "distribute your contributions under the same license", "if you remix transform or build upon the material you must distribute your contributions under the same license as the original"),
    ("cc-nd", 60, "may not distribute the modified material", "if you remix transform or build upon the material you may not distribute the modified material"),
    ("cc-nc", 60, "may not use the material for commercial purposes", "you may not use the material for commercial purposes"),
    ("ogl-uk-3.0", 90, "open government licence", "(?:contains public sector information )?licensed under the open government licence v ?3 0"),
    ("cdla-permissive-2.0", 90, "community data license agreement", "community data license agreement permissive(?: version)? 2 0"),
    ("cdla-sharing-1.0", 90, "community data license agreement", "community data license agreement sharing(?: version)? 1 0"),
    ("cdla-permissive-1.0", 90, "community data license agreement", "community data license agreement permissive(?: version)? 1 0"),
    # terms that keep uses back
    ("commons-clause", 97, "commons clause", "(?:the software is provided to you by the licensor under the license as defined below subject to the following condition(?: [^ ]+){0,6}? )?commons clause(?: license condition v1 0)?"),
    ("commons-clause", 97, "does not grant to you the right to sell", "the grant of rights under the license will not include and the license does not grant to you the right to sell the software"),
    ("busl-1.1", 60, "non production use", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("elastic-2.0", 60, "hosted or managed service", "you may not provide the software to third parties as a hosted or managed service where the service provides users with access to any substantial set of the features or functionality of the software"),
    ("polyform-noncommercial-1.0.0", 90, "polyform noncommercial", "polyform noncommercial license(?: 1 0 0)?"),
    ("polyform-small-business-1.0.0", 90, "polyform small business", "polyform small business license(?: 1 0 0)?"),
    ("rail", 85, "use based restrictions", "use based restrictions(?: [^ ]+){1,20}? (?:must|shall) be included as an enforceable provision"),
    ("openrail-m", 90, "openrail m", "(?:bigscience |creativeml )?(?:open rail m|openrail m)(?: license)?"),
    ("all-rights-reserved", 30, "no part of this publication may be reproduced", "no part of this publication may be reproduced(?: distributed)?(?: stored in a retrieval system)?(?: or transmitted)? in any form or by any means"),
    ("proprietary", 35, "proprietary and confidential", "(?:this (?:file|software|document) is |is )?(?:the )?(?:proprietary and confidential|confidential and proprietary)(?: information)?"),
    ("proprietary", 35, "unauthorized copying of this file", "unauthorized copying of this file via any medium is strictly prohibited"),
]
_IS_WORD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _compiled(pattern: str) -> re.Pattern:
    return re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])".encode())


@cache
def _rules() -> tuple[ahocorasick.Automaton, list[tuple[int, str, re.Pattern]]]:
    """The keywords, each with the numbers of its rules; and the rules in order: (priority, label, expression)."""
    rules, of = [], {}
    for form_priority, form in FORMS:
        for label, keywords, name in LICENSES:
            for keyword in keywords:
                of.setdefault(keyword, []).append(len(rules))
            rules.append((form_priority, label, _compiled(form.replace("{name}", f"(?:{name})"))))
    for label, priority, keyword, sentence in SIGNATURES:
        of.setdefault(keyword, []).append(len(rules))
        rules.append((priority, label, _compiled(sentence)))
    keys = ahocorasick.Automaton()
    for keyword, numbers in of.items():
        keys.add_word(keyword, tuple(numbers))
    keys.make_automaton()
    return keys, rules


@cache
def _base() -> list[tuple[bytes, re.Pattern, str]]:
    return [(phrase.split()[0].encode(), _compiled(phrase), label) for phrase, label in BASE.items()]


def _outermost(found: list[tuple[int, int]]) -> list[int]:
    """Of intervals (begin, end), strongest first, the numbers of those that lie in no stronger one.

    For each begin a Fenwick tree tells the furthest end of the intervals so far that begin no later, so times stay in
    proportion to the detections, however many there are.
    """
    place = {x: k + 1 for k, x in enumerate(sorted({begin for begin, _ in found}))}
    furthest, left = [-1] * (len(place) + 1), []
    for number, (begin, end) in enumerate(found):
        k, most = place[begin], -1
        while k:
            most = max(most, furthest[k])
            k &= k - 1
        if most < end:
            left.append(number)
            k = place[begin]
            while k < len(furthest):
                furthest[k] = max(furthest[k], end)
                k += k & -k
    return left


def scan(text: str | None) -> dict:
    """n_words, places of the base phrases (word numbers), base labels, labels, and the detections that are left as
    (label, priority, first word, last word)."""
    spelt = (text or "").encode("utf-8", "surrogatepass").lower().translate(_IS_WORD).split()
    words = b" ".join(spelt)
    begins, base = [], set()
    for first, pattern, label in _base():
        if first in words:
            for m in pattern.finditer(words):
                begins.append(m.start())
                base.add(label)
    keys, rules = _rules()
    padded = f" {words.decode('utf-8', 'replace')} "
    due = sorted({k for _, numbers in keys.iter(padded) for k in numbers})
    found = []
    for k in due:
        priority, label, pattern = rules[k]
        found += [(-priority, m.start() - m.end(), m.start(), k, label) for m in pattern.finditer(words)]
    found.sort()
    found = [found[k] for k in _outermost([(start, start - size) for _, size, start, _, _ in found])]
    spaces = np.flatnonzero(np.frombuffer(words, np.uint8) == 32) if begins or found else None
    number = lambda places: np.searchsorted(spaces, places).tolist() if places else []
    first, last = number([x[2] for x in found]), number([x[2] - x[1] for x in found])
    left = [(label, -priority, f, w) for (priority, _, _, _, label), f, w in zip(found, first, last)]
    return {"n_words": len(spelt), "starts": number(sorted(begins)), "base": sorted(base), "labels": sorted(base | {x[0] for x in left}), "detections": left}


_DETECTION = pa.list_(pa.struct([("label", pa.string()), ("priority", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64())]))
_COLUMNS = {
    "n_words": (T.LongType(), pa.int64()), "n_base": (T.LongType(), pa.int64()), "first_word": (T.LongType(), pa.int64()), "last_word": (T.LongType(), pa.int64()),
    "base_labels": (T.StringType(), pa.string()), "labels": (T.StringType(), pa.string()), "score": (T.DoubleType(), pa.float64()),
    "detections": (T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("priority", T.IntegerType()), T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType())])), _DETECTION),
}


def with_licenses(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels, score and detections."""
    docs = docs.drop(*_COLUMNS)
    kept = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    schema = T.StructType([*kept, *[T.StructField(k, v[0]) for k, v in _COLUMNS.items()]])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            rows = [scan(x) for x in batch.column(batch.schema.names.index(text_col)).to_pylist()]
            told = {
                "n_words": [r["n_words"] for r in rows], "n_base": [len(r["starts"]) for r in rows], "first_word": [min(r["starts"], default=None) for r in rows], "last_word": [max(r["starts"], default=None) for r in rows],
                "base_labels": [",".join(r["base"]) for r in rows], "labels": [",".join(r["labels"]) for r in rows],
                "score": [max([x[1] for x in r["detections"]] + [BASE_PRIORITY] * bool(r["base"]), default=0) / 100 for r in rows],
                "detections": [[dict(zip(("label", "priority", "first_word", "last_word"), x)) for x in r["detections"]] for r in rows],
            }
            columns = [batch.column(batch.schema.names.index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(v, _COLUMNS[k][1]) for k, v in told.items()]], names=[*[f.name for f in kept], *told])

    return docs.mapInArrow(look, schema)
