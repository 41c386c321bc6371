"""Licence scan: ordered signature rules behind a keyword prefilter.

A text is reduced to its lower-case words joined by single spaces.  Each rule is a regular
expression over that form with one keyword, a word that every match must hold; a rule runs
only where its keyword stands in the text, so most texts run no rule at all.  Detections are
resolved in order of priority, then length, then rule order: one whose words lie within an
accepted detection is suppressed.

The base phrases are looked up apart from the rules and are never suppressed.  Rows are
scanned whole and one by one in the tasks that read them; nothing is shuffled or collected.

Defined cases: null and empty texts have no words, no labels and score 0; repeated rows and
null ids give a row each; phrases only match whole words, across any punctuation.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlab.llm.common import WORD_BYTES

# phrase words -> label
BASE = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
BASE_WEIGHT = 0.5

_LIC = "licen[cs]es?"
_V = "(?:v|version |v )?"

# label, keyword (one a way of writing the name), how the name is written, the identifier's words, words of its address
NAMES = [
    ("apache-2.0", "apache", rf"apache (?:software )?{_LIC} {_V}2(?: 0)?", "apache 2 0", "apache org licenses license 2 0"),
    ("apache-1.1", "apache", rf"apache (?:software )?{_LIC} {_V}1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("apache", "apache", rf"apache (?:software )?{_LIC}", "apache", "apache org licenses"),
    ("mit", "mit", rf"mit (?:x11 )?{_LIC}", "mit", "opensource org licenses mit"),
    ("x11", "x11", rf"x11 {_LIC}", "x11", "xfree86 org 3 3 6 copyright2 x11"),
    ("isc", "isc", rf"isc {_LIC}", "isc", "opensource org licenses isc"),
    ("0bsd", "bsd", rf"(?:zero clause|0 clause) bsd(?: {_LIC})?", "0bsd", "opensource org licenses bsd 0"),
    ("bsd-2-clause", "bsd", rf"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)(?: {_LIC})?", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "bsd", rf"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd)(?: {_LIC})?", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "bsd", rf"(?:bsd 4 clause|4 clause bsd|original bsd)(?: {_LIC})?", "bsd 4 clause", "directory fsf org wiki license bsd 4 clause"),
    ("bsd", "bsd", rf"bsd(?: style)? {_LIC}", "bsd", "opensource org licenses bsd"),
    ("gpl-1.0", "public", rf"(?:gnu )?general public {_LIC} {_V}1(?: 0)?", "gpl 1 0", "gnu org licenses old licenses gpl 1 0"),
    ("gpl-2.0", "public", rf"(?:gnu )?general public {_LIC} {_V}2(?: 0)?", "gpl 2 0", "gnu org licenses old licenses gpl 2 0"),
    ("gpl-3.0", "public", rf"(?:gnu )?general public {_LIC} {_V}3(?: 0)?", "gpl 3 0", "gnu org licenses gpl 3 0"),
    ("gpl-any", "gnu", rf"gnu (?:general public {_LIC}|gpl)", "gpl", "gnu org licenses gpl"),
    ("lgpl-2.0", "public", rf"(?:gnu )?library general public {_LIC} {_V}2(?: 0)?", "lgpl 2 0", "gnu org licenses old licenses lgpl 2 0"),
    ("lgpl-2.1", "public", rf"(?:gnu )?lesser general public {_LIC} {_V}2 1", "lgpl 2 1", "gnu org licenses old licenses lgpl 2 1"),
    ("lgpl-3.0", "public", rf"(?:gnu )?lesser general public {_LIC} {_V}3(?: 0)?", "lgpl 3 0", "gnu org licenses lgpl 3 0"),
    ("lgpl", "public", rf"(?:gnu )?(?:lesser|library) general public {_LIC}", "lgpl", "gnu org licenses lgpl"),
    ("agpl-3.0", "affero", rf"(?:gnu )?affero general public {_LIC}(?: {_V}3(?: 0)?)?", "agpl 3 0", "gnu org licenses agpl 3 0"),
    ("gfdl-1.2", "documentation", rf"(?:gnu )?free documentation {_LIC} {_V}1 2", "gfdl 1 2", "gnu org licenses old licenses fdl 1 2"),
    ("gfdl-1.3", "documentation", rf"(?:gnu )?free documentation {_LIC}(?: {_V}1 3)?", "gfdl 1 3", "gnu org licenses fdl 1 3"),
    ("mpl-1.1", "mozilla", rf"mozilla public {_LIC} {_V}1 1", "mpl 1 1", "mozilla org mpl mpl 1 1"),
    ("mpl-2.0", "mozilla", rf"mozilla public {_LIC}(?: {_V}2(?: 0)?)?", "mpl 2 0", "mozilla org mpl 2 0"),
    ("epl-1.0", "eclipse", rf"eclipse public {_LIC} {_V}1(?: 0)?", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse", rf"eclipse public {_LIC}(?: {_V}2(?: 0)?)?", "epl 2 0", "eclipse org legal epl 2 0"),
    ("cddl-1.0", "cddl", r"cddl(?: 1 0)?", "cddl 1 0", "opensource org licenses cddl"),
    ("cddl-long", "distribution", rf"common development and distribution {_LIC}", "cddl 1 1", "oracle com cddl"),
    ("cpl-1.0", "common", rf"common public {_LIC}(?: {_V}1 0)?", "cpl 1 0", "opensource org licenses cpl"),
    ("eupl-1.2", "european", rf"european union public {_LIC}(?: {_V}1 [012])?", "eupl 1 2", "joinup ec europa eu software page eupl"),
    ("artistic-2.0", "artistic", rf"artistic {_LIC}(?: {_V}2 0)?", "artistic 2 0", "opensource org licenses artistic"),
    ("bsl-1.0", "boost", rf"boost software {_LIC}(?: {_V}1 0)?", "bsl 1 0", "boost org license 1 0"),
    ("zlib", "zlib", rf"zlib(?: libpng)? {_LIC}", "zlib", "zlib net zlib license"),
    ("libpng", "libpng png", rf"(?:png reference library|libpng) {_LIC}", "libpng", "libpng org pub png src libpng license"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "wtfpl", r"wtfpl(?: 2)?", "wtfpl", "wtfpl net"),
    ("beerware", "beerware", rf"beerware(?: {_LIC})?", "beerware", "people freebsd org phk"),
    ("public-domain", "domain", r"(?:in|into|to) the public domain", "public domain", "creativecommons org publicdomain mark"),
    ("cc0-1.0", "cc0", rf"cc0(?: 1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero"),
    ("ofl-1.1", "font", rf"(?:sil )?open font {_LIC}(?: {_V}1 1)?", "ofl 1 1", "scripts sil org ofl"),
    ("ms-pl", "microsoft", rf"microsoft public {_LIC}", "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft", rf"microsoft reciprocal {_LIC}", "ms rl", "opensource org licenses ms rl"),
    ("psf-2.0", "python psf", rf"(?:python software foundation|psf) {_LIC}(?: {_V}2)?", "psf 2 0", "docs python org license"),
    ("postgresql", "postgresql", rf"postgresql {_LIC}", "postgresql", "opensource org licenses postgresql"),
    ("ncsa", "illinois", rf"university of illinois(?: ncsa)? open source {_LIC}", "ncsa", "opensource org licenses ncsa"),
    ("openssl", "openssl", rf"openssl {_LIC}", "openssl", "openssl org source license"),
    ("php-3.01", "php", rf"php {_LIC}(?: {_V}3 01)?", "php 3 01", "php net license 3 01"),
    ("ruby", "ruby", rf"ruby {_LIC}", "ruby", "ruby lang org en about license"),
    ("w3c", "w3c", rf"w3c(?: software)?(?: notice and)? {_LIC}", "w3c", "w3 org consortium legal"),
    ("zpl-2.1", "zope", rf"zope public {_LIC}(?: {_V}2 1)?", "zpl 2 1", "old zope org resources license zpl"),
    ("upl-1.0", "permissive", rf"universal permissive {_LIC}(?: {_V}1 0)?", "upl 1 0", "opensource org licenses upl"),
    ("odbl-1.0", "database", rf"open (?:data commons )?database {_LIC}", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("odc-by-1.0", "attribution", rf"open data commons attribution {_LIC}", "odc by 1 0", "opendatacommons org licenses by"),
    ("pddl-1.0", "dedication", rf"public domain dedication and {_LIC}", "pddl 1 0", "opendatacommons org licenses pddl"),
    ("mulan-2.0", "mulan", rf"mulan (?:psl|permissive software {_LIC})(?: v2)?", "mulanpsl 2 0", "license coscl org cn mulanpsl2"),
    ("cecill-2.1", "cecill", rf"cecill(?: [bc])?(?: {_LIC})?", "cecill 2 1", "cecill info licences"),
    ("sspl-1.0", "server", rf"server side public {_LIC}", "sspl 1 0", "mongodb com licensing server side public license"),
    ("elastic-2.0", "elastic", rf"elastic {_LIC}(?: {_V}2 0)?", "elastic 2 0", "elastic co licensing elastic license"),
    ("busl-1.1", "business", rf"business source {_LIC}(?: {_V}1 1)?", "busl 1 1", "mariadb com bsl11"),
    ("vim", "vim", rf"vim {_LIC}", "vim", "vimhelp org uganda txt"),
    ("curl", "curl", rf"curl {_LIC}", "curl", "curl se docs copyright"),
    ("freetype", "freetype", rf"freetype(?: project)? {_LIC}", "ftl", "freetype org license"),
    ("unicode", "unicode", rf"unicode {_LIC}(?: agreement)?", "unicode dfs 2016", "unicode org copyright"),
    ("json", "json", r"the json licen[cs]e", "json", "json org license"),
]
# the Creative Commons family: kinds by version
CC_KINDS = {"by": "attribution", "by sa": "attribution share ?alike", "by nd": "attribution no ?deriv(?:ative)?s",
            "by nc": "attribution non ?commercial", "by nc sa": "attribution non ?commercial share ?alike",
            "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s"}
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

_GRANT = "(?:licen[cs]ed|released|distributed|available|published|provided|covered|redistribut(?:ed|e))"
# priority, weight, pattern around the name, keyword that replaces the name's own
CONTEXTS = [
    (4, 0.99, r"spdx licen[cs]e identifier {spdx}(?: only| or later)?", "spdx"),
    (3, 0.95, rf"{_GRANT}(?: [a-z0-9]+){{{{0,4}}}} under (?:the |an? )?(?:terms of (?:the )?)?(?:conditions of (?:the )?)?{{name}}", None),
    (2, 0.90, r"(?:https? )?(?:www )?{url}", None),
    (1, 0.60, r"{name}", None),
]
# detections that name no licence: priority, weight, label, keyword, pattern
PLAIN = [
    (1, 0.60, "reserved-notice", "reserved", r"(?:some|no|all) rights (?:are )?reserved"),
    (2, 0.80, "copyright", "copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?(?: by)?(?: [a-z0-9]+){1,3}"),
    (1, 0.40, "copyright", "copyright", r"copyright"),
    (3, 0.90, "permission-grant", "permission", r"permission is hereby granted free of charge to any person"),
    (3, 0.90, "redistribution", "redistribution", r"redistribution and use in source and binary forms"),
    (2, 0.70, "warranty", "warranty", r"without (?:any )?warranty(?: of any kind)?"),
    (2, 0.70, "warranty", "warranties", r"without (?:any )?warranties(?: or conditions of any kind| of any kind)?"),
    (3, 0.90, "proprietary", "confidential", r"proprietary and confidential|confidential and proprietary"),
    (2, 0.80, "free-software", "redistribute", r"free software you can redistribute it and or modify"),
]

_LATER = "(?: or later| or newer| or any later version| only)?"
_THIS = "(?:the |this )?"
# Rules written one by one: priority, weight, label, keyword, pattern.  First names by abbreviation
# and version, then tags and expressions, then sentences of licence texts, then notices.
WRITTEN = [
    (2, 0.90, "gpl-1.0", "gplv1", rf"(?:gnu )?gplv1(?: 0)?{_LATER}"),
    (2, 0.90, "gpl-2.0", "gplv2", rf"(?:gnu )?gplv2(?: 0)?{_LATER}"),
    (2, 0.90, "gpl-3.0", "gplv3", rf"(?:gnu )?gplv3(?: 0)?{_LATER}"),
    (2, 0.85, "gpl-2.0", "gpl2", rf"(?:gnu )?gpl2{_LATER}"),
    (2, 0.85, "gpl-3.0", "gpl3", rf"(?:gnu )?gpl3{_LATER}"),
    (2, 0.85, "gpl-1.0", "gpl", rf"(?:gnu )?gpl (?:v1|v 1|version 1|1 0|ver 1)(?: 0)?{_LATER}"),
    (2, 0.90, "gpl-2.0", "gpl", rf"(?:gnu )?gpl (?:v2|v 2|version 2|2 0|ver 2)(?: 0)?{_LATER}"),
    (2, 0.90, "gpl-3.0", "gpl", rf"(?:gnu )?gpl (?:v3|v 3|version 3|3 0|ver 3)(?: 0)?{_LATER}"),
    (1, 0.50, "gpl-any", "gpl", r"(?:the |under |gnu )gpl"),
    (2, 0.80, "gpl-any", "gpl", r"gpl (?:licen[cs]ed|licen[cs]e|compatible)"),
    (2, 0.90, "lgpl-2.0", "lgplv2", rf"(?:gnu )?lgplv2(?: 0)?{_LATER}"),
    (3, 0.90, "lgpl-2.1", "lgplv2", rf"(?:gnu )?lgplv2 1{_LATER}"),
    (2, 0.90, "lgpl-3.0", "lgplv3", rf"(?:gnu )?lgplv3(?: 0)?{_LATER}"),
    (2, 0.85, "lgpl-2.1", "lgpl21", rf"lgpl21{_LATER}"),
    (2, 0.85, "lgpl-3.0", "lgpl3", rf"lgpl3{_LATER}"),
    (2, 0.90, "lgpl-2.0", "lgpl", rf"(?:gnu )?lgpl (?:v2|v 2|version 2|2 0)(?: 0)?{_LATER}"),
    (3, 0.90, "lgpl-2.1", "lgpl", rf"(?:gnu )?lgpl (?:v2 1|v 2 1|version 2 1|2 1){_LATER}"),
    (2, 0.90, "lgpl-3.0", "lgpl", rf"(?:gnu )?lgpl (?:v3|v 3|version 3|3 0)(?: 0)?{_LATER}"),
    (1, 0.60, "lgpl", "lgpl", r"(?:gnu )?lgpl(?: licen[cs]ed?)?"),
    (2, 0.90, "agpl-3.0", "agplv3", rf"(?:gnu )?agplv3(?: 0)?{_LATER}"),
    (2, 0.85, "agpl-3.0", "agpl3", rf"agpl3{_LATER}"),
    (2, 0.90, "agpl-3.0", "agpl", rf"(?:gnu )?agpl (?:v3|v 3|version 3|3 0)(?: 0)?{_LATER}"),
    (2, 0.85, "agpl-1.0", "agpl", rf"agpl (?:v1|version 1|1 0){_LATER}"),
    (1, 0.60, "agpl-any", "agpl", r"(?:gnu )?agpl(?: licen[cs]ed?)?"),
    (2, 0.85, "gfdl-1.1", "gfdl", r"gfdl (?:v1 1|version 1 1|1 1)"),
    (2, 0.85, "gfdl-1.2", "gfdl", r"gfdl (?:v1 2|version 1 2|1 2)"),
    (2, 0.85, "gfdl-1.3", "gfdl", r"gfdl (?:v1 3|version 1 3|1 3)"),
    (1, 0.60, "gfdl-1.3", "gfdl", r"(?:gnu )?gfdl"),
    (2, 0.90, "apache-2.0", "apache", r"apache (?:v2|version 2|2)(?: 0)?(?: licen[cs]ed| licen[cs]e)?"),
    (2, 0.85, "apache-1.1", "apache", r"apache (?:v1 1|version 1 1|1 1)(?: licen[cs]ed| licen[cs]e)?"),
    (2, 0.85, "apache-1.0", "apache", r"apache (?:v1|version 1|1 0)(?: licen[cs]ed| licen[cs]e)?"),
    (2, 0.80, "apache-2.0", "asl", r"asl (?:v2|version 2|2)(?: 0)?"),
    (2, 0.80, "apache-2.0", "apache2", r"apache2(?: 0)?(?: licen[cs]ed?)?"),
    (2, 0.85, "apache", "apache", r"apache licen[cs]ed"),
    (2, 0.85, "mit", "mit", r"mit licen[cs]ed"),
    (2, 0.80, "mit", "mit", r"mit style licen[cs]e"),
    (2, 0.80, "mit", "expat", r"expat licen[cs]ed?"),
    (2, 0.85, "mit-0", "mit", r"mit (?:0|no attribution)(?: licen[cs]e)?"),
    (2, 0.80, "isc", "isc", r"isc licen[cs]ed"),
    (2, 0.80, "bsd", "bsd", r"bsd licen[cs]ed"),
    (2, 0.85, "bsd-2-clause", "bsd2", r"bsd2(?: clause)?"),
    (2, 0.85, "bsd-3-clause", "bsd3", r"bsd3(?: clause)?"),
    (2, 0.85, "bsd-2-clause", "freebsd", r"freebsd licen[cs]e"),
    (2, 0.85, "bsd-3-clause", "bsd", r"revised bsd(?: licen[cs]e)?"),
    (2, 0.85, "bsd-1-clause", "bsd", r"(?:bsd 1 clause|1 clause bsd)(?: licen[cs]e)?"),
    (2, 0.85, "mpl-1.0", "mpl", r"mpl (?:v1|version 1|1)(?: 0)?"),
    (3, 0.85, "mpl-1.1", "mpl", r"mpl (?:v1 1|version 1 1|1 1)"),
    (2, 0.90, "mpl-2.0", "mpl", r"mpl (?:v2|version 2|2)(?: 0)?"),
    (2, 0.85, "mpl-2.0", "mplv2", r"mplv2(?: 0)?"),
    (2, 0.85, "epl-1.0", "epl", r"epl (?:v1|version 1|1)(?: 0)?"),
    (2, 0.85, "epl-2.0", "epl", r"epl (?:v2|version 2|2)(?: 0)?"),
    (2, 0.85, "edl-1.0", "eclipse", r"eclipse distribution licen[cs]e(?: v1 0| version 1 0| 1 0)?"),
    (2, 0.85, "eupl-1.1", "eupl", r"eupl (?:v1 1|version 1 1|v 1 1|1 1)"),
    (2, 0.85, "eupl-1.2", "eupl", r"eupl (?:v1 2|version 1 2|v 1 2|1 2)"),
    (2, 0.85, "cddl-1.1", "cddl", r"cddl (?:v1 1|version 1 1|1 1)"),
    (2, 0.85, "osl-3.0", "open", r"open software licen[cs]e(?: v3 0| version 3 0| 3 0)?"),
    (2, 0.85, "afl-3.0", "academic", r"academic free licen[cs]e(?: v3 0| version 3 0| 3 0)?"),
    (2, 0.80, "cc0-1.0", "zero", r"creative commons (?:cc )?zero(?: v1 0| 1 0)?"),
    (2, 0.85, "cc-by", "creative", r"creative commons attribution(?: licen[cs]e)?"),
    (1, 0.50, "cc", "creative", r"creative commons(?: licen[cs]e)?"),
    (2, 0.85, "ofl-1.1", "ofl", r"(?:sil )?ofl(?: v1 1| version 1 1| 1 1)?"),
    (2, 0.85, "blueoak-1.0.0", "oak", r"blue oak model licen[cs]e(?: 1 0 0)?"),
    (2, 0.85, "hippocratic", "hippocratic", r"hippocratic licen[cs]e"),
    (2, 0.85, "polyform", "polyform", r"polyform (?:noncommercial|strict|shield|small business|free trial|perimeter)(?: licen[cs]e)?"),
    (2, 0.85, "commons-clause", "clause", r"commons clause(?: licen[cs]e)?(?: condition)?"),
    (2, 0.85, "openrail", "openrail", r"(?:creativeml )?openrail(?: m)?(?: licen[cs]e)?"),
    (2, 0.85, "llama", "llama", r"llama (?:2 |3 )?community licen[cs]e(?: agreement)?"),
    # tags and expressions
    (1, 0.95, "spdx-expression", "or", r"spdx licen[cs]e identifier [a-z0-9 ]{2,40}? or [a-z0-9]+(?: \d)*"),
    (1, 0.95, "spdx-expression", "and", r"spdx licen[cs]e identifier [a-z0-9 ]{2,40}? and [a-z0-9]+(?: \d)*"),
    (4, 0.95, "spdx-exception", "exception", r"with (?:classpath|gcc|llvm|autoconf|bison|openssl|linux syscall|font) (?:[a-z0-9]+ ){0,2}exception(?: \d(?: \d)?)?"),
    (3, 0.90, "mit", "mit", r"licen[cs]e (?:is )?mit"),
    (3, 0.90, "apache-2.0", "apache", r"licen[cs]e (?:is )?apache 2(?: 0)?"),
    (3, 0.90, "bsd-2-clause", "bsd", r"licen[cs]e (?:is )?bsd 2 clause"),
    (3, 0.90, "bsd-3-clause", "bsd", r"licen[cs]e (?:is )?bsd 3 clause"),
    (3, 0.85, "bsd", "bsd", r"licen[cs]e (?:is )?bsd"),
    (3, 0.90, "gpl-2.0", "gpl", rf"licen[cs]e (?:is )?gpl 2(?: 0)?{_LATER}"),
    (3, 0.90, "gpl-3.0", "gpl", rf"licen[cs]e (?:is )?gpl 3(?: 0)?{_LATER}"),
    (3, 0.85, "gpl-any", "gpl", r"licen[cs]e (?:is )?gpl"),
    (3, 0.90, "lgpl-2.1", "lgpl", rf"licen[cs]e (?:is )?lgpl 2 1{_LATER}"),
    (3, 0.90, "lgpl-3.0", "lgpl", rf"licen[cs]e (?:is )?lgpl 3(?: 0)?{_LATER}"),
    (3, 0.90, "agpl-3.0", "agpl", rf"licen[cs]e (?:is )?agpl 3(?: 0)?{_LATER}"),
    (3, 0.90, "mpl-2.0", "mpl", r"licen[cs]e (?:is )?mpl 2(?: 0)?"),
    (3, 0.90, "isc", "isc", r"licen[cs]e (?:is )?isc"),
    (3, 0.90, "cc0-1.0", "cc0", r"licen[cs]e (?:is )?cc0(?: 1 0)?"),
    (3, 0.90, "unlicense", "unlicense", r"licen[cs]e (?:is )?unlicense"),
    (3, 0.90, "unlicensed", "unlicensed", r"licen[cs]e (?:is )?unlicensed"),
    (3, 0.90, "proprietary", "proprietary", r"licen[cs]e (?:is )?proprietary"),
    (3, 0.90, "dual-license", "dual", r"dual licen[cs]ed"),
    (3, 0.85, "dual-license", "tri", r"tri licen[cs]ed"),
    (3, 0.90, "mit", "mit", r"under mit(?: licen[cs]e)?"),
    (3, 0.90, "apache-2.0", "apache", r"(?:under|or|and) apache 2(?: 0)?"),
    (3, 0.85, "bsd", "bsd", r"under (?:a |the )?bsd(?: style)?"),
    (3, 0.80, "see-license", "file", r"see (?:the )?(?:accompanying )?licen[cs]e (?:txt |md )?file(?: for (?:more )?(?:details|information|terms))?"),
    (3, 0.80, "see-license", "copying", r"see (?:the )?(?:file )?copying(?: lesser)?(?: for (?:more )?(?:details|information|terms))?"),
    (3, 0.80, "see-license", "licensed", r"licensed (?:as specified|as described|as stated) in"),
    (2, 0.70, "classifier-osi", "osi", r"osi approved"),
    # sentences of licence texts
    (4, 0.95, "mit", "merge", r"to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    (4, 0.90, "mit", "permit", r"to permit persons to whom the software is furnished to do so"),
    (3, 0.85, "mit", "substantial", r"shall be included in all copies or substantial portions of the software"),
    (3, 0.85, "mit", "noninfringement", r"fitness for a particular purpose and noninfringement"),
    (4, 0.90, "isc", "hereby", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    (4, 0.90, "isc", "disclaims", r"the author disclaims all warranties with regard to this software"),
    (3, 0.85, "bsd", "retain", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    (3, 0.85, "bsd", "reproduce", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    (4, 0.90, "bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software"),
    (4, 0.90, "bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    (3, 0.85, "bsd", "contributors", r"this software is provided by the (?:copyright holders|regents|author|authors) and contributors"),
    (4, 0.95, "apache-2.0", "compliance", r"you may not use this file except in compliance with the license"),
    (4, 0.90, "apache-2.0", "distributed", r"software distributed under the license is distributed on an as is basis"),
    (4, 0.90, "apache-2.0", "limitations", r"language governing permissions and limitations under the license"),
    (4, 0.90, "apache-2.0", "irrevocable", r"perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    (4, 0.95, "gpl-any", "redistribute", r"redistribute it and or modify it under the terms of the gnu general public license"),
    (4, 0.90, "gpl-any", "useful", r"distributed in the hope that it will be useful but without any warranty"),
    (3, 0.85, "gpl-any", "received", r"you should have received a copy of the gnu general public license"),
    (4, 0.90, "lgpl", "received", r"you should have received a copy of the gnu (?:lesser|library) general public license"),
    (4, 0.90, "agpl-3.0", "received", r"you should have received a copy of the gnu affero general public license"),
    (4, 0.90, "lgpl", "redistribute", r"redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    (4, 0.90, "gpl-any", "freedom", r"designed to take away your freedom to share and change"),
    (4, 0.90, "gpl-3.0", "copyleft", r"free copyleft license for software and other kinds of works"),
    (3, 0.85, "gpl-any", "verbatim", r"everyone is permitted to copy and distribute verbatim copies of this license document"),
    (4, 0.90, "mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    (4, 0.90, "mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public license version 1 1"),
    (3, 0.85, "mpl-2.0", "obtain", r"if a copy of the mpl was not distributed with this file you can obtain one"),
    (4, 0.90, "epl-2.0", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    (4, 0.90, "zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    (4, 0.90, "zlib", "altered", r"altered source versions must be plainly marked as such"),
    (4, 0.90, "zlib", "implied", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    (4, 0.90, "bsl-1.0", "boost", r"distributed under the boost software license"),
    (4, 0.90, "bsl-1.0", "executable", r"machine executable object code generated by a source language processor"),
    (4, 0.90, "unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    (4, 0.90, "unlicense", "anyone", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    (4, 0.90, "wtfpl", "fuck", r"do what the fuck you want to"),
    (4, 0.90, "cc0-1.0", "waived", r"waived all copyright and related or neighboring rights"),
    (4, 0.90, "cc0-1.0", "dedicated", r"(?:has |have )?dedicated (?:the work|this work|all copyright) to the public domain"),
    (3, 0.85, "cc-by", "credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made"),
    (3, 0.85, "cc-by-sa", "remix", r"if you remix transform or build upon the material you must distribute your contributions under the same license"),
    (3, 0.85, "cc-by-nc", "purposes", r"you may not use the material for commercial purposes"),
    (4, 0.90, "ofl-1.1", "fonts", r"the fonts and derivatives however cannot be released under any other type of license"),
    (4, 0.90, "artistic-2.0", "package", r"copyright holder intends that the package"),
    (4, 0.90, "php-3.01", "php", r"this product includes php software freely available from"),
    (4, 0.90, "openssl", "openssl", r"this product includes software developed by the openssl project"),
    (3, 0.85, "postgresql", "documentation", r"permission to use copy modify and distribute this software and its documentation for any purpose"),
    (4, 0.90, "ncsa", "illinois", r"neither the names of (?:[a-z0-9]+ ){0,6}illinois"),
    (4, 0.85, "sspl-1.0", "service", r"offering the program as a service"),
    (4, 0.85, "busl-1.1", "change", r"change date (?:[a-z0-9]+ ){1,4}change license"),
    # notices
    (2, 0.70, "warranty", "provided", rf"{_THIS}(?:software |program |work |code |material )?(?:is )?provided as is"),
    (2, 0.70, "warranty", "as", r"on an as is basis"),
    (2, 0.70, "warranty", "merchantability", r"warrant(?:y|ies) of merchantability"),
    (2, 0.60, "liability", "liable", r"in no event shall (?:[a-z0-9]+ ){1,12}be liable"),
    (2, 0.80, "copyright", "c", r"c (?:19|20)\d\d(?: (?:19|20)\d\d| present)?(?: by)?(?: [a-z0-9]+){1,3}"),
    (2, 0.80, "copyright", "©", r"©(?: copyright)?(?: (?:19|20)\d\d)?(?: (?:19|20)\d\d| present)?(?: by)?(?: [a-z0-9]+){0,3}"),
    (2, 0.75, "copyright", "copr", r"copr (?:19|20)\d\d"),
    (2, 0.75, "copyright", "copyrighted", r"copyrighted (?:by|material|work)"),
    (2, 0.75, "proprietary", "trade", r"trade secrets? of [a-z0-9]+"),
    (2, 0.75, "proprietary", "unauthorized", r"unauthorized (?:copying|use|reproduction|distribution)(?: or (?:copying|use|reproduction|distribution))? (?:[a-z0-9]+ ){0,4}(?:is |are )?(?:strictly )?prohibited"),
    (2, 0.70, "proprietary", "permission", r"without (?:the )?(?:prior |express |written ){1,3}permission"),
    (2, 0.70, "proprietary", "confidential", r"(?:company|strictly|highly) confidential"),
    (2, 0.70, "non-commercial", "commercial", r"(?:for )?non commercial (?:use|purposes) only"),
    (2, 0.70, "non-commercial", "noncommercial", r"(?:for )?noncommercial (?:use|purposes) only"),
    (2, 0.70, "non-commercial", "personal", r"for personal use only"),
    (2, 0.70, "research-only", "research", r"for (?:academic |scientific )?research (?:use|purposes) only"),
    (2, 0.70, "redistribution-allowed", "freely", r"(?:may|can) be (?:used |copied |modified |redistributed |distributed |and ){1,6}freely"),
    (2, 0.70, "eula", "eula", r"eula"),
    (2, 0.70, "eula", "user", r"end user licen[cs]e agreement"),
    (2, 0.60, "terms", "terms", r"subject to the (?:following )?terms and conditions"),
    (2, 0.70, "patent-grant", "patent", r"patent licen[cs]e to make have made use offer to sell sell import"),
    (2, 0.70, "attribution", "attribution", r"attribution (?:is )?required"),
]


@dataclass(frozen=True)
class Rule:
    priority: int
    weight: float
    label: str
    keyword: str
    regex: re.Pattern


def _whole_words(pattern: str) -> re.Pattern:
    # ASCII only: other white space and digits are parts of words
    return re.compile(rf"(?<!\S)(?:{pattern})(?!\S)", re.ASCII)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules in order: every name in every context, those written one by one, the plain ones."""
    names = list(NAMES)
    for kind, words in CC_KINDS.items():
        for v in CC_VERSIONS:
            names.append((f"cc-{kind}-{v}".replace(" ", "-", kind.count(" ")).replace(" ", "."), kind.split()[-1],
                          rf"(?:cc {kind}|creative commons {words})(?: {_LIC})?(?: {_V}{v}|(?: international| unported) {v})",
                          f"cc {kind} {v}", f"creativecommons org licenses {kind} {v}"))
    out = []
    for label, keyword, name, spdx, url in names:
        for priority, weight, context, own in CONTEXTS:
            if own or "{url}" in context:
                keys = [own or url.split()[0]]
            else:
                # the name is written out or abbreviated: a rule for each, with its own keyword
                keys = ["cc", "creative"] if label.startswith("cc-") else keyword.split()
            regex = _whole_words(context.format(name=f"(?:{name})", spdx=spdx, url=url))
            out += [Rule(priority, weight, label, key, regex) for key in keys]
    out += [Rule(p, w, label, key, _whole_words(pattern)) for p, w, label, key, pattern in WRITTEN + PLAIN]
    return tuple(out)


@lru_cache(maxsize=1)
def _gate() -> tuple[frozenset, dict[str, list[tuple[int, Rule]]]]:
    by_key: dict[str, list[tuple[int, Rule]]] = {}
    for n, rule in enumerate(rules()):
        by_key.setdefault(rule.keyword, []).append((n, rule))
    keys = {k.encode() for k in by_key} | {p[-1].encode() for p in BASE}
    return frozenset(keys), by_key


def resolve(found: list[tuple[int, int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """(start, end, rule) of the detections that stand, from (start, end, order, rule)."""
    kept: list[tuple[int, int, Rule]] = []
    # a Fenwick tree over the distinct starts holds the furthest accepted end up to each of them,
    # so a text of many detections takes n log n steps
    starts = sorted({d[0] for d in found})
    furthest = [0] * (len(starts) + 1)
    for start, end, _, rule in sorted(found, key=lambda d: (-d[3].priority, d[0] - d[1], d[2], d[0])):
        at = place = bisect_left(starts, start) + 1
        reach = 0
        while at:
            reach = max(reach, furthest[at])
            at &= at - 1
        if reach < end:
            kept.append((start, end, rule))
            while place < len(furthest):
                furthest[place] = max(furthest[place], end)
                place += place & -place
    return sorted(kept, key=lambda d: (d[0], d[1]))


_BASE_RULES = {label: _whole_words(" ".join(phrase)) for phrase, label in BASE.items()}


def scan(text: bytes | None) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, Rule]]]:
    """(number of words, base places as (word, label), detections in words)."""
    words = text.translate(WORD_BYTES).split() if text else []
    keys, by_key = _gate()
    present = keys.intersection(words)
    if not present:
        return len(words), [], []
    form = b" ".join(words).decode("utf-8", "replace")
    begins = [0, *(m.end() for m in re.finditer(" ", form))]
    word_at = lambda at: bisect_right(begins, at) - 1
    base = [(word_at(m.start()), label) for label, regex in _BASE_RULES.items() for m in regex.finditer(form)]
    found = [(m.start(), m.end(), n, rule)
             for key in present for n, rule in by_key.get(key.decode(), ()) for m in rule.regex.finditer(form)]
    return len(words), base, [(word_at(s), word_at(e) + 1, rule) for s, e, rule in resolve(found)]


def report(text: bytes | None) -> tuple:
    n_words, base, found = scan(text)
    places = [at for at, _ in base]
    base_labels = sorted({label for _, label in base})
    labels = sorted({label for _, label in base} | {rule.label for _, _, rule in found})
    miss = (1 - BASE_WEIGHT) ** bool(base)
    for _, _, rule in found:
        miss *= 1 - rule.weight
    return (n_words, len(base), min(places, default=None), max(places, default=None), ",".join(base_labels),
            ",".join(labels), 1 - miss, [(s, e, rule.label) for s, e, rule in found])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), _SPANS]
_NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
_DDL = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
        "score double, spans array<struct<start:bigint,end:bigint,label:string>>")


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [report(t) for t in batch.column(1).to_pylist()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_TYPES)
        spans = pa.array([[{"start": s, "end": e, "label": x} for s, e, x in row] for row in columns[7]], _SPANS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(columns[:7], _TYPES[:7], strict=True)), spans],
            names=["id", *_NAMES])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, word and base figures, labels, score, and the spans
    (start, end in words, label) of the detections that stand."""
    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return read.mapInArrow(_scan_batches, f"id {kind}, {_DDL}").withColumnRenamed("id", id_col)
