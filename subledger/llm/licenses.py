"""License scan: ordered signature rules over whole texts.

Every rule is a hand-written regular expression with a label and a priority.
From its parse come keywords of which every match holds one (white space as one
blank, case folded). An Aho-Corasick pass over the text in that form finds which
occur; only rules with an occurring keyword are run. Detections overlap (``MIT
License`` lies inside ``released under the MIT License``): they are taken in
order of priority, then length, then start, and a detection that lies wholly
inside one already kept is suppressed.

The base phrases (``mit license`` and so on) are looked up as consecutive words
and always stay among the labels.
"""

from __future__ import annotations

import re
from functools import cache
from re import _parser

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.llm.common import WORD_BYTES

#: Base phrases (fixed values): the words, the label.
BASE_PHRASES = (
    ((b"mit", b"license"), "mit"),
    ((b"apache", b"license"), "apache"),
    ((b"general", b"public", b"license"), "gpl"),
)

#: License families: label, name pattern, SPDX id pattern.
_VERSION = r"(?:,?\s*(?:version|v\.?|ver\.?)?\s*{})"
FAMILIES = (
    ("mit", r"(?:the\s+)?mit(?:\s*/\s*x11)?(?:\s+license)?", r"MIT(?:-0)?"),
    ("x11", r"(?:the\s+)?x11\s+license", r"X11"),
    ("isc", r"(?:the\s+)?isc\s+license", r"ISC"),
    ("apache-1.1", r"(?:the\s+)?apache(?:\s+software)?\s+license" + _VERSION.format(r"1\.1"), r"Apache-1\.1"),
    ("apache-2.0", r"(?:the\s+)?apache(?:\s+software)?\s+license" + _VERSION.format(r"2(?:\.0)?"), r"Apache-2\.0"),
    ("apache", r"(?:the\s+)?apache(?:\s+software)?\s+license", r"Apache"),
    ("gpl-1.0", r"(?:the\s+)?(?:gnu\s+)?gpl" + _VERSION.format(r"1(?:\.0)?"), r"GPL-1\.0(?:-only|-or-later|\+)?"),
    ("gpl-2.0", r"(?:the\s+)?(?:gnu\s+)?gpl" + _VERSION.format(r"2(?:\.0)?"), r"GPL-2\.0(?:-only|-or-later|\+)?"),
    ("gpl-3.0", r"(?:the\s+)?(?:gnu\s+)?gpl" + _VERSION.format(r"3(?:\.0)?"), r"GPL-3\.0(?:-only|-or-later|\+)?"),
    ("gpl", r"(?:the\s+)?gnu\s+gpl", r"GPL"),
    ("gpl-2.0", r"(?:the\s+)?(?:gnu\s+)?general\s+public\s+license" + _VERSION.format(r"2(?:\.0)?"), r"GPLv2"),
    ("gpl-3.0", r"(?:the\s+)?(?:gnu\s+)?general\s+public\s+license" + _VERSION.format(r"3(?:\.0)?"), r"GPLv3"),
    ("gpl", r"(?:the\s+)?(?:gnu\s+)?general\s+public\s+license", r"GPL-any"),
    ("lgpl-2.0", r"(?:the\s+)?(?:gnu\s+)?(?:lesser|library)\s+general\s+public\s+license" + _VERSION.format(r"2(?:\.0)?"), r"LGPL-2\.0(?:-only|-or-later|\+)?"),
    ("lgpl-2.1", r"(?:the\s+)?(?:gnu\s+)?lgpl" + _VERSION.format(r"2\.1"), r"LGPL-2\.1(?:-only|-or-later|\+)?"),
    ("lgpl-3.0", r"(?:the\s+)?(?:gnu\s+)?lgpl" + _VERSION.format(r"3(?:\.0)?"), r"LGPL-3\.0(?:-only|-or-later|\+)?"),
    ("lgpl", r"(?:the\s+)?(?:gnu\s+)?lesser\s+general\s+public\s+license", r"LGPL"),
    ("agpl-3.0", r"(?:the\s+)?(?:gnu\s+)?agpl" + _VERSION.format(r"3(?:\.0)?"), r"AGPL-3\.0(?:-only|-or-later|\+)?"),
    ("agpl", r"(?:the\s+)?(?:gnu\s+)?affero\s+general\s+public\s+license", r"AGPL"),
    ("gfdl", r"(?:the\s+)?(?:gnu\s+)?free\s+documentation\s+license", r"GFDL(?:-1\.[123])?"),
    ("bsd-0-clause", r"(?:the\s+)?(?:bsd\s+zero[\s-]clause|0[\s-]clause\s+bsd)(?:\s+license)?", r"0BSD"),
    ("bsd-2-clause", r"(?:the\s+)?(?:simplified|freebsd|2[\s-]clause|two[\s-]clause)\s+bsd(?:\s+license)?", r"BSD-2-Clause"),
    ("bsd-3-clause", r"(?:the\s+)?(?:new|modified|revised|3[\s-]clause|three[\s-]clause)\s+bsd(?:\s+license)?", r"BSD-3-Clause"),
    ("bsd-4-clause", r"(?:the\s+)?(?:original|old|4[\s-]clause|four[\s-]clause)\s+bsd(?:\s+license)?", r"BSD-4-Clause"),
    ("bsd", r"(?:the\s+)?bsd(?:[\s-]style)?\s+license", r"BSD"),
    ("mpl-1.1", r"(?:the\s+)?mozilla\s+public\s+license" + _VERSION.format(r"1\.1"), r"MPL-1\.1"),
    ("mpl-2.0", r"(?:the\s+)?mozilla\s+public\s+license" + _VERSION.format(r"2(?:\.0)?"), r"MPL-2\.0"),
    ("mpl", r"(?:the\s+)?mozilla\s+public\s+license", r"MPL"),
    ("epl-1.0", r"(?:the\s+)?eclipse\s+public\s+license" + _VERSION.format(r"1(?:\.0)?"), r"EPL-1\.0"),
    ("epl-2.0", r"(?:the\s+)?eclipse\s+public\s+license" + _VERSION.format(r"2(?:\.0)?"), r"EPL-2\.0"),
    ("epl", r"(?:the\s+)?eclipse\s+public\s+license", r"EPL"),
    ("cddl", r"(?:the\s+)?common\s+development\s+and\s+distribution\s+license", r"CDDL-1\.[01]"),
    ("cpl", r"(?:the\s+)?common\s+public\s+license", r"CPL-1\.0"),
    ("artistic", r"(?:the\s+)?artistic\s+license(?:\s+2\.0)?", r"Artistic-(?:1|2)\.0"),
    ("zlib", r"(?:the\s+)?zlib(?:/libpng)?\s+license", r"Zlib"),
    ("boost", r"(?:the\s+)?boost\s+software\s+license(?:[\s,-]*(?:version\s+)?1\.0)?", r"BSL-1\.0"),
    ("busl", r"(?:the\s+)?business\s+source\s+license(?:\s+1\.1)?", r"BUSL-1\.1"),
    ("unlicense", r"(?:the\s+)?unlicense", r"Unlicense"),
    ("wtfpl", r"(?:the\s+)?wtfpl", r"WTFPL"),
    ("cc0", r"cc0(?:[\s-]*1\.0)?(?:\s+universal)?", r"CC0-1\.0"),
    ("cc-by-nc-nd", r"(?:cc[\s-]by[\s-]nc[\s-]nd|creative\s+commons\s+attribution[\s-]*non-?commercial[\s-]*no-?deriv\w*)(?:[\s-]*[1-4]\.[05])?", r"CC-BY-NC-ND-[1-4]\.[05]"),
    ("cc-by-nc-sa", r"(?:cc[\s-]by[\s-]nc[\s-]sa|creative\s+commons\s+attribution[\s-]*non-?commercial[\s-]*share-?alike)(?:[\s-]*[1-4]\.[05])?", r"CC-BY-NC-SA-[1-4]\.[05]"),
    ("cc-by-nc", r"(?:cc[\s-]by[\s-]nc|creative\s+commons\s+attribution[\s-]*non-?commercial)(?:[\s-]*[1-4]\.[05])?", r"CC-BY-NC-[1-4]\.[05]"),
    ("cc-by-nd", r"(?:cc[\s-]by[\s-]nd|creative\s+commons\s+attribution[\s-]*no-?deriv\w*)(?:[\s-]*[1-4]\.[05])?", r"CC-BY-ND-[1-4]\.[05]"),
    ("cc-by-sa", r"(?:cc[\s-]by[\s-]sa|creative\s+commons\s+attribution[\s-]*share-?alike)(?:[\s-]*[1-4]\.[05])?", r"CC-BY-SA-[1-4]\.[05]"),
    ("cc-by", r"(?:cc[\s-]by|creative\s+commons\s+attribution)(?:[\s-]*[1-4]\.[05])?", r"CC-BY-[1-4]\.[05]"),
    ("odbl", r"(?:the\s+)?open\s+database\s+license", r"ODbL-1\.0"),
    ("odc-by", r"(?:the\s+)?open\s+data\s+commons\s+attribution\s+license", r"ODC-By-1\.0"),
    ("eupl", r"(?:the\s+)?european\s+union\s+public\s+licen[cs]e", r"EUPL-1\.[012]"),
    ("osl", r"(?:the\s+)?open\s+software\s+license", r"OSL-[123]\.[01]"),
    ("afl", r"(?:the\s+)?academic\s+free\s+license", r"AFL-[123]\.[01]"),
    ("ms-pl", r"(?:the\s+)?microsoft\s+public\s+license", r"MS-PL"),
    ("ms-rl", r"(?:the\s+)?microsoft\s+reciprocal\s+license", r"MS-RL"),
    ("psf", r"(?:the\s+)?python\s+software\s+foundation\s+license", r"PSF-2\.0"),
    ("php", r"(?:the\s+)?php\s+license", r"PHP-3\.0[01]?"),
    ("ruby", r"(?:the\s+)?ruby\s+license", r"Ruby"),
    ("postgresql", r"(?:the\s+)?postgresql\s+license", r"PostgreSQL"),
    ("openssl", r"(?:the\s+)?openssl\s+license", r"OpenSSL"),
    ("ofl", r"(?:the\s+)?(?:sil\s+)?open\s+font\s+license", r"OFL-1\.[01]"),
    ("ncsa", r"(?:the\s+)?(?:university\s+of\s+illinois/)?ncsa(?:\s+open\s+source)?\s+license", r"NCSA"),
    ("cecill", r"(?:the\s+)?cecill(?:-[abc])?\s+license", r"CECILL-(?:2\.[01]|B|C)"),
    ("sspl", r"(?:the\s+)?server\s+side\s+public\s+license", r"SSPL-1\.0"),
)

#: Ways in which a text names a license: form, priority, pattern around the name.
FORMS = (
    ("grant", 80, r"\b(?:licensed|released|distributed|available|provided|published)\s+under\s+(?:the\s+terms\s+of\s+)?{}\b"),
    ("under", 70, r"\bunder\s+(?:the\s+terms\s+of\s+)?{}\b"),
    ("heading", 60, r"\blicen[cs]e\s*[:=]\s*{}\b"),
    ("name", 40, r"\b{}(?<=[0-9a-z])\b"),
)

#: Sentences that are signatures of their own: label, priority, pattern.
SENTENCES = (
    ("mit", 90, r"permission\s+is\s+hereby\s+granted,?\s+free\s+of\s+charge,?\s+to\s+any\s+person\s+obtaining\s+a\s+copy"),
    ("isc", 90, r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software\s+for\s+any\s+purpose"),
    ("bsd", 90, r"redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms"),
    ("bsd-3-clause", 91, r"neither\s+the\s+names?\s+of\s+[\s\S]{1,200}?\s+may\s+be\s+used\s+to\s+endorse\s+or\s+promote"),
    ("bsd-4-clause", 92, r"all\s+advertising\s+materials\s+mentioning\s+features"),
    ("apache-2.0", 90, r"https?://www\.apache\.org/licenses/LICENSE-2\.0"),
    ("gpl", 90, r"gnu\s+general\s+public\s+license\s+as\s+published\s+by\s+the\s+free\s+software\s+foundation"),
    ("mpl-2.0", 90, r"this\s+source\s+code\s+form\s+is\s+subject\s+to\s+the\s+terms\s+of\s+the\s+mozilla\s+public\s+license"),
    ("boost", 90, r"distributed\s+under\s+the\s+boost\s+software\s+license"),
    ("unlicense", 90, r"this\s+is\s+free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain"),
    ("mit", 88, r"the\s+above\s+copyright\s+notice\s+and\s+this\s+permission\s+notice\s+shall\s+be\s+included\s+in\s+all\s+copies"),
    ("mit-0", 93, r"permission\s+is\s+hereby\s+granted,?\s+free\s+of\s+charge,?\s+to\s+any\s+person\s+obtaining\s+a\s+copy\s+of\s+this\s+software[\s\S]{1,400}?to\s+permit\s+persons\s+to\s+whom\s+the\s+software\s+is\s+furnished\s+to\s+do\s+so\."),
    ("x11", 91, r"except\s+as\s+contained\s+in\s+this\s+notice,?\s+the\s+names?\s+of[\s\S]{1,120}?\s+shall\s+not\s+be\s+used\s+in\s+advertising"),
    ("isc", 88, r"appear\s+in\s+all\s+copies\.\s+the\s+software\s+is\s+provided\s+[\"“']?as\s+is"),
    ("bsd-0-clause", 92, r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software\s+for\s+any\s+purpose\s+with\s+or\s+without\s+fee\s+is\s+hereby\s+granted\.\s+the\s+software"),
    ("bsd", 87, r"redistributions\s+of\s+source\s+code\s+must\s+retain\s+the\s+above\s+copyright"),
    ("bsd", 87, r"redistributions\s+in\s+binary\s+form\s+must\s+reproduce\s+the\s+above\s+copyright"),
    ("apache-2.0", 89, r"licensed\s+under\s+the\s+apache\s+license,\s+version\s+2\.0\s+\(the\s+[\"“']license"),
    ("apache-2.0", 86, r"you\s+may\s+not\s+use\s+this\s+file\s+except\s+in\s+compliance\s+with\s+the\s+license"),
    ("apache-1.1", 91, r"this\s+product\s+includes\s+software\s+developed\s+by\s+the\s+apache\s+software\s+foundation"),
    ("gnu-2.0-or-later", 92, r"either\s+version\s+2\s+of\s+the\s+license,?\s+or\s+\(at\s+your\s+option\)\s+any\s+later\s+version"),
    ("gnu-3.0-or-later", 92, r"either\s+version\s+3\s+of\s+the\s+license,?\s+or\s+\(at\s+your\s+option\)\s+any\s+later\s+version"),
    ("gnu", 85, r"free\s+software[:;,]\s+you\s+can\s+redistribute\s+it\s+and/or\s+modify\s+it\s+under\s+the\s+terms"),
    ("gpl", 84, r"you\s+should\s+have\s+received\s+a\s+copy\s+of\s+the\s+gnu\s+general\s+public\s+license"),
    ("lgpl", 93, r"gnu\s+(?:lesser|library)\s+general\s+public\s+license\s+as\s+published\s+by\s+the\s+free\s+software\s+foundation"),
    ("lgpl", 85, r"you\s+should\s+have\s+received\s+a\s+copy\s+of\s+the\s+gnu\s+(?:lesser|library)\s+general\s+public\s+license"),
    ("agpl", 93, r"gnu\s+affero\s+general\s+public\s+license\s+as\s+published\s+by\s+the\s+free\s+software\s+foundation"),
    ("agpl-3.0", 88, r"remote\s+network\s+interaction;\s+use\s+with\s+the\s+gnu\s+general\s+public\s+license"),
    ("gpl", 86, r"https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?gpl(?:-[0-9.]+)?"),
    ("lgpl", 86, r"https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?lgpl(?:-[0-9.]+)?"),
    ("agpl", 86, r"https?://(?:www\.)?gnu\.org/licenses/agpl(?:-[0-9.]+)?"),
    ("gfdl", 92, r"permission\s+is\s+granted\s+to\s+copy,\s+distribute\s+and/or\s+modify\s+this\s+document\s+under\s+the\s+terms\s+of\s+the\s+gnu\s+free\s+documentation"),
    ("gpl-classpath", 92, r"as\s+a\s+special\s+exception,?\s+the\s+copyright\s+holders\s+of\s+this\s+library\s+give\s+you\s+permission\s+to\s+link"),
    ("mpl-2.0", 88, r"you\s+can\s+obtain\s+one\s+at\s+https?://mozilla\.org/MPL/2\.0"),
    ("mpl-1.1", 91, r"the\s+contents\s+of\s+this\s+file\s+are\s+subject\s+to\s+the\s+mozilla\s+public\s+license"),
    ("mpl-tri", 90, r"mpl\s+1\.1/gpl\s+2\.0/lgpl\s+2\.1"),
    ("epl", 90, r"this\s+program\s+and\s+the\s+accompanying\s+materials\s+are\s+made\s+available\s+under\s+the\s+terms\s+of\s+the\s+eclipse"),
    ("epl", 86, r"https?://www\.eclipse\.org/legal/epl-(?:v10|2\.0)"),
    ("cddl", 90, r"the\s+contents\s+of\s+this\s+file\s+are\s+subject\s+to\s+the\s+terms\s+of\s+the\s+common\s+development\s+and\s+distribution"),
    ("zlib", 90, r"this\s+software\s+is\s+provided\s+[\"“']?as-is[\"”']?,\s+without\s+any\s+express\s+or\s+implied\s+warranty"),
    ("zlib", 88, r"altered\s+source\s+versions\s+must\s+be\s+plainly\s+marked\s+as\s+such"),
    ("boost", 88, r"https?://www\.boost\.org/LICENSE_1_0\.txt"),
    ("wtfpl", 91, r"do\s+what\s+the\s+f\*?u?ck\s+you\s+want\s+to\s+public\s+license"),
    ("beerware", 90, r"if\s+we\s+meet\s+some\s+day,?\s+and\s+you\s+think\s+this\s+stuff\s+is\s+worth\s+it"),
    ("cc0", 91, r"has\s+waived\s+all\s+copyright\s+and\s+related\s+or\s+neighbou?ring\s+rights"),
    ("artistic", 90, r"same\s+terms\s+as\s+perl\s+itself"),
    ("ruby", 90, r"same\s+terms\s+as\s+ruby\s+itself"),
    ("psf", 90, r"psf\s+is\s+making\s+python\s+available\s+to\s+licensee"),
    ("php", 90, r"this\s+product\s+includes\s+php\s+software,?\s+freely\s+available"),
    ("openssl", 90, r"this\s+product\s+includes\s+software\s+developed\s+by\s+the\s+openssl\s+project"),
    ("ofl", 90, r"this\s+font\s+software\s+is\s+licensed\s+under\s+the\s+sil\s+open\s+font\s+license"),
    ("ncsa", 90, r"to\s+deal\s+with\s+the\s+software\s+without\s+restriction"),
    ("ms-pl", 88, r"this\s+license\s+governs\s+use\s+of\s+the\s+accompanying\s+software"),
    ("cecill", 90, r"governed\s+by\s+the\s+cecill(?:-[abc])?\s+license\s+under\s+french\s+law"),
    ("eupl", 90, r"licensed\s+under\s+the\s+eupl"),
    ("sspl", 90, r"offering\s+the\s+program\s+as\s+a\s+service[\s\S]{1,120}?service\s+source\s+code"),
    ("busl", 90, r"the\s+licensor\s+hereby\s+grants\s+you\s+the\s+right\s+to\s+copy,\s+modify,\s+create\s+derivative\s+works,\s+redistribute"),
    ("elastic-2.0", 90, r"elastic\s+license\s+2\.0"),
    ("commons-clause", 90, r"[\"“']commons\s+clause[\"”']?\s+license\s+condition"),
    ("json", 92, r"the\s+software\s+shall\s+be\s+used\s+for\s+good,\s+not\s+evil"),
    ("hpnd", 88, r"permission\s+to\s+use,\s+copy,\s+modify\s+and\s+distribute\s+this\s+software\s+and\s+its\s+documentation\s+for\s+any\s+purpose"),
    ("curl", 89, r"in\s+no\s+event\s+shall\s+the\s+authors\s+or\s+copyright\s+holders\s+be\s+liable\s+for\s+any\s+claim,\s+damages\s+or\s+other\s+liability,[\s\S]{1,200}?except\s+as\s+contained\s+in\s+this\s+notice"),
    ("odbl", 88, r"https?://(?:www\.)?opendatacommons\.org/licenses/odbl"),
    ("proprietary", 56, r"(?:confidential\s+and\s+proprietary|proprietary\s+and\s+confidential)"),
    ("proprietary", 54, r"no\s+part\s+of\s+this\s+(?:publication|document|work|book)\s+may\s+be\s+(?:reproduced|copied|distributed)"),
    ("proprietary", 54, r"without\s+the\s+(?:express\s+)?(?:prior\s+)?written\s+(?:permission|consent)\s+of\s+the\s+(?:publisher|author|owner|copyright\s+holder)s?"),
    ("non-commercial", 58, r"for\s+(?:personal,?\s+)?non-?commercial\s+use\s+only"),
    ("warranty-disclaimer", 21, r"merchantability\s+(?:or|and)\s+fitness\s+for\s+a\s+particular\s+purpose"),
    ("public-domain", 60, r"(?:in|into|to)\s+the\s+public\s+domain"),
    ("proprietary", 50, r"all\s+rights\s+reserved"),
    ("proprietary", 55, r"unauthori[sz]ed\s+(?:copying|use|distribution|reproduction)[^.]{0,80}\s+prohibited"),
    ("copyright-notice", 30, r"copyright\s+(?:\(c\)|©|\d{4})"),
    ("warranty-disclaimer", 20, r"(?:provided|distributed)\s+[\"“']?as\s+is[\"”']?,?\s+without\s+warrant"),
    ("cc", 85, r"https?://creativecommons\.org/(?:licenses|publicdomain)/[a-z-]+/[0-9.]+"),
    ("cc", 35, r"creative\s+commons\s+licen[cs]e"),
)


#: Strings that a keyword set holds at most.
_MOST = 16
#: Letters outside ASCII that IGNORECASE takes for one inside, which lower() does not.
_CASELESS = (("\u0130", "i"), ("\u0131", "i"), ("\u017f", "s"))


def normalised(text: str) -> str:
    """Lower-cased text, every run of white space (also none at the ends) one blank."""
    if not text.isascii():
        for odd, plain in _CASELESS:
            text = text.replace(odd, plain)
    return f" {' '.join(text.lower().split())} "


def _joined(a: set[str], b: set[str]) -> set[str]:
    return {re.sub(" +", " ", x + y) for x in a for y in b}


def _needs(parsed) -> tuple[set[str] | None, set[str]]:
    """(all strings that a parsed pattern matches, or None; strings of which every
    match holds one), both as they stand in ``normalised`` text."""
    run, found, exact = {""}, [], True

    def weight(keys: set[str]) -> tuple[int, int]:
        return min(map(len, keys)), -len(keys)

    for op, arg in parsed:
        step: set[str] | None = None
        more: set[str] = set()
        if op in (_parser.AT, _parser.ASSERT, _parser.ASSERT_NOT):
            continue
        if op is _parser.LITERAL:
            step = {chr(arg).lower()}
        elif op is _parser.IN:
            if all(o is _parser.LITERAL or (o, a) == (_parser.CATEGORY, _parser.CATEGORY_SPACE) for o, a in arg):
                step = {chr(a).lower() if o is _parser.LITERAL else " " for o, a in arg}
        elif op is _parser.SUBPATTERN:
            step, more = _needs(arg[3])
        elif op is _parser.BRANCH:
            each = [_needs(x) for x in arg[1]]
            step = set().union(*(e for e, _ in each)) if all(e is not None for e, _ in each) else None
            more = set().union(*(m for _, m in each))
        elif op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT):
            least, most, inner = arg
            once, must = _needs(inner)
            more = must if least else {""}
            if once is not None and (most == 1 or once == {" "}):
                step = once if least else once | {""}
        if step is not None and len(longer := _joined(run, step)) <= _MOST:
            run = longer
            continue
        found += [run, more or {""}]
        run, exact = {""}, False
    return (run if exact else None), max([*found, run], key=weight)


def keywords(pattern: str) -> frozenset[str]:
    """Strings of which every match of ``pattern`` holds at least one, in ``normalised`` text."""
    return frozenset(_needs(_parser.parse(pattern, re.IGNORECASE))[1])


@cache
def rules() -> tuple[tuple[str, int, frozenset[str], re.Pattern], ...]:
    """(label, priority, keywords, pattern), highest priority first."""
    out = [(label, prio, pat) for label, prio, pat in SENTENCES]
    for label, name, spdx in FAMILIES:
        out.append((label, 95, rf"SPDX-License-Identifier:\s*\(?{spdx}(?![\w.-])"))
        for form, prio, around in FORMS:
            # A bare name must say what it is: 'mit' alone is also an acronym or a word.
            own = name.replace(r"(?:\s+license)?", r"\s+license") if form == "name" else name
            out.append((label, prio, around.format(own)))
    return tuple((label, prio, keywords(pat), re.compile(pat, re.IGNORECASE)) for label, prio, pat in sorted(out, key=lambda r: -r[1]))


@cache
def _gate() -> ahocorasick.Automaton:
    """Keyword -> the indexes of its rules."""
    by_key: dict[str, list[int]] = {}
    for i, r in enumerate(rules()):
        for key in r[2]:
            by_key.setdefault(key, []).append(i)
    machine = ahocorasick.Automaton()
    for key, ids in by_key.items():
        machine.add_word(key, ids)
    machine.make_automaton()
    return machine


def gated(text: str) -> set[int]:
    """The indexes of the rules that may match: one of their keywords occurs."""
    active: set[int] = set()
    for _, ids in _gate().iter(normalised(text)):
        active.update(ids)
    return active


def detect(text: str) -> list[tuple[int, int, str, int]]:
    """Detections (start, end, label, priority) of one text after suppression."""
    found = [(m.start(), m.end(), r[0], r[1]) for i in sorted(gated(text)) for r in (rules()[i],) for m in r[3].finditer(text)]
    # By priority, then the more specific label of the longer match; contained ones go.
    found.sort(key=lambda d: (-d[3], d[0] - d[1], d[0], d[2]))
    place = {start: i for i, start in enumerate(sorted({d[0] for d in found}), 1)}
    reach = [-1] * (len(place) + 1)  # binary indexed: largest end of the kept ones up to a start
    kept: list[tuple[int, int, str, int]] = []
    for d in found:
        i, furthest = place[d[0]], -1
        while i:
            furthest, i = max(furthest, reach[i]), i & (i - 1)
        if furthest >= d[1]:
            continue
        kept.append(d)
        i = place[d[0]]
        while i < len(reach):
            reach[i], i = max(reach[i], d[1]), i + (i & -i)
    return sorted(kept)


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(word index, label) of every place of a base phrase."""
    out, at = [], -1
    for _ in range(words.count(b"license")):
        at = words.index(b"license", at + 1)
        for phrase, label in BASE_PHRASES:
            start = at + 1 - len(phrase)
            if start >= 0 and tuple(words[start : at + 1]) == phrase:
                out.append((start, label))
    return out


RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("detections", T.ArrayType(T.StringType())),
    ]
)


def _scan(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        text = text if isinstance(text, str) else ""
        words = text.encode("utf-8", "replace").translate(WORD_BYTES).split()
        places = base_places(words)
        found = detect(text)
        base = {label for _, label in places}
        starts = [s for s, _ in places]
        rows.append(
            (
                len(words),
                len(places),
                min(starts, default=None),
                max(starts, default=None),
                ",".join(sorted(base)),
                ",".join(sorted(base | {d[2] for d in found})),
                max([d[3] / 100 for d in found] + [0.9] * bool(places), default=0.0),
                [f"{d[2]}:{d[0]}:{d[1]}" for d in found],
            )
        )
    out = pd.DataFrame(rows, columns=RESULT.fieldNames())
    for c in ("n_words", "n_base", "first_word", "last_word"):
        out[c] = out[c].astype("Int64")
    return out


def scan_licenses(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id and the fields of ``RESULT``.

    ``detections`` lists label:start:end in code points of the text, sorted.
    A null or empty text has no words, no labels and score 0; rows that repeat
    stay and get equal results; other columns are passed over. No shuffle: each
    text is scanned whole where it is read.
    """
    scan = F.pandas_udf(_scan, RESULT)
    hit = documents.select(F.col(id_col).alias("doc_id"), scan(F.col(text_col)).alias("r"))
    return hit.select("doc_id", "r.*")
