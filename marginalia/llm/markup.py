"""Markup residue in texts: what there is of it, and the clean text with headings, lists, code and formulas kept.

A text is unescaped, its tags are parsed into a DOM, and composite text density picks the content: every node has
link-adjusted characters per tag; the densities of its children are summed; the node of the largest sum is the
content's root, and the least density on its path from the body is the threshold below which side branches are left
out. Fragments without links, such as titles and abstracts, have no side branches, so they are kept whole. LaTeX, wiki
and Markdown signs in the text of the DOM are then rewritten.

Code and formulas are set aside before anything else is rewritten and put back at the end as they were.

Texts are handled one by one in Arrow batches; texts without any of the characters that all markup needs (SIGNS) stay in
the JVM.
"""

from __future__ import annotations

import html
import html.entities
import math
import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of elements of HTML, JATS and MathML, and of character entities.
ELEMENTS = (
    "a abbr acronym address article aside b bdi bdo big blockquote body bold br button caption center cite code col colgroup dd del details dfn dir div dl dt em fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header "
    "hr html i iframe img inf input ins italic kbd label legend li link list list-item main mark math menu meta mfrac mi mn mo mover mroot mrow mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder nav nobr noscript nowiki ol "
    "p para param pre q ref references s samp sc script sec section select small source span strike strong style sub summary sup svg table tbody td textarea tfoot th thead time title tr tt u ul underline var video wbr xref ext-link "
    "inline-formula disp-formula tex-math monospace inline-graphic disp-quote"
)
ENTITIES = (
    "amp lt gt quot apos nbsp ndash mdash hellip bull middot lsquo rsquo sbquo ldquo rdquo bdquo laquo raquo lsaquo rsaquo times divide deg plusmn micro copy reg trade euro pound yen cent sect para iexcl iquest ordf ordm frac12 frac14 frac34 "
    "sup1 sup2 sup3 alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau upsilon phi chi psi omega Alpha Beta Gamma Delta Theta Lambda Sigma Phi Psi Omega le ge ne equiv asymp sim minus infin sum prod int "
    "radic part nabla larr rarr uarr darr harr isin shy thinsp ensp emsp zwj zwnj prime Prime permil dagger Dagger szlig aelig AElig oelig OElig eth ETH thorn THORN"
)
_E = "|".join(sorted(ELEMENTS.split(), key=lambda x: (-len(x), x)))
_PREFIX = "(?:jats|mml|xlink|tei|xhtml|html|m|ns\\d)"
_N = f"(?:{_PREFIX}:[a-z][a-z0-9-]*|{_E})"
#: Every name that HTML 5 defines with a final semicolon.
_NAMED = "|".join(sorted(n[:-1] for n in html.entities.html5 if n.endswith(";")))
_REF = "|".join(ENTITIES.split()) + "|[a-zA-Z](?:acute|grave|circ|uml|tilde|cedil|ring|slash|caron)"
_COMMANDS = (
    "begin end emph textbf textit textsc textrm texttt textsf textsubscript textsuperscript underline mathrm mathbf mathit mathcal mathbb cite citep citet ref eqref label section subsection subsubsection paragraph item footnote url href mbox "
    "alpha beta gamma delta epsilon varepsilon theta lambda mu nu pi rho sigma tau phi chi psi omega Gamma Delta Theta Lambda Sigma Phi Psi Omega sum prod int frac sqrt times cdot pm leq geq neq approx sim infty partial ldots dots cdots ast circ "
    "degree rightarrow to left right quad qquad noindent newline hspace vspace caption maketitle bf em it sc rm tt small large par ss ae oe aa"
)
#: Patterns by family of markup. Plain comparisons, prices, products, paths, indices, matrices and notes match none.
PATTERNS = {
    "html": [
        rf"(?i)<\s*/?\s*{_N}(?=[\s/>])[^<>]*>",  # a whole tag, also with stray blanks
        rf"(?i)<\s*/\s*{_N}\b|<{_PREFIX}:|<{_N}\s+[a-z:-]+\s*=|<{_N}\b(?=[^<>]*(?:<|$))",  # without its end
        rf"(?i)(?<![\w</:])/?{_N}\s?/?>(?!>)|/{_N}>(?!>)|(?<![\w<])/\s?{_N}\s?>(?!>)|\b(?:jats|mml):[a-z]",  # without its start
        r"</?[a-zA-Z][a-zA-Z0-9]*[:-][\w:.-]+[^<>]*>|</[a-zA-Z][\w:.-]*\s*>|<[a-zA-Z]{2,}[\w:.-]*(?:\s+[\w:.-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*\s*/?>",
        r"<!--|-->|<!\[CDATA\[|\]\]>|<!DOCTYPE|<\?xml",
    ],
    "reference": [
        rf"&(?:amp;)*#(?:\d{{2,6}}|[xX][0-9a-fA-F]{{2,5}})|&(?:amp;)*(?:{_NAMED});|&(?:{_REF})(?=[^a-zA-Z0-9=;]|$)",
        rf"(?<![\w&])(?:amp|lt|gt|quot|nbsp|apos);|(?<!\w)(?:amp;)+(?:#\d+|{_REF});|(?<![\w&])#\d{{3,5}};",
        r"(?i)\\u003[ce]|%3[ce](?=[\w/%])|\\x3[ce]",
    ],
    "latex": [
        r"(?<![\w:\\])\\(?:" + "|".join(_COMMANDS.split()) + r")(?![a-zA-Z\\])",
        r"\\[a-zA-Z]+\*?\s*[\[{]|\{\\[a-zA-Z]+|\\[\"'`^~=.]\s*\{?\\?[a-zA-Z]|(?<![\w:])\\[()\[\],;!%&$#_{}]|\\\\(?![\w.])|~\\|[\^_]\{",
        r"\$\$|\$(?![$\s])[^$\\^_=\n]*[\\^_=][^$\n]*(?<!\s)\$(?!\d)|\$[a-zA-Z]\$|\$\\[a-zA-Z]+",
        r"``[^`'\n]+''",
    ],
    "markdown": [
        r"!\[[^\[\]\n]*\]\([^()\n]*\)?|\[[^\[\]\n]+\]\((?:https?://|www\.|/|#|mailto:|\.)[^\s)]*\)?|\[[^\[\]\n]+\]\[[^\[\]\s,]*\]|[\w,]\]\[\d+\]|(?m:^\s{0,3}\[[^\]\n]+\]:\s*\S+)|\[\^\w+\]|<https?://[^\s>]+>",
        r"(?<![\w*])\*{1,3}(?=[^\s*])(?:[^*\n]*[^\s*])\*{1,3}(?![\w*])|(?<![\w_])_{1,3}(?=[^\s_])(?:[^_\n]*[^\s_])_{1,3}(?![\w_])|\*\*|~~",
        r"`[^`\n]+`|```|(?m:^~~~)",
        r"(?m)^\s{0,3}#{1,6}[ \t]+\S|\n\s{0,3}(?:={3,}|-{3,})[ \t]*(?:\n|$)|^[ \t]*\|.*\|[ \t]*$|^\s{0,3}[*+-][ \t]+\S.*\n(?s:.*?)^\s{0,3}[*+-][ \t]+\S|\n[*+-][ \t]+\S|^\s{0,3}>[ \t]+\S|^\d{1,3}[.)][ \t]+\S.*\n+\d{1,3}[.)][ \t]+\S",
    ],
    "wiki": [
        r"\[\[(?!\s*-?\d+(?:\.\d+)?\s*[,;\]]\s*[-\d\[])[^\[\]\n]+(?:\]\]|\||$)|\{\{(?!\s*[-\d{])[^{}\n|]+(?:\}\}|\|)|\{\||(?m:^\|[}-])|(?<![\d'])''+(?=[^\s'])[^'\n]+''+|'''(?=[^\s'])[^\n]+?'''",
        r"(?m)^={2,6}[^=\n]+={2,6}\s*$|^[*#:;]{1,5}[ \t]*\S.*\n[*#:;]{1,5}[ \t]*\S|__[A-Z]{3,}__|\[https?://\S+(?:\s[^\]\n]*)?\]",
    ],
}
#: What every pattern of a family needs; no pattern of it is tried without.
NEEDS = {"html": r"[<>:]", "reference": r"[&;\\%]", "latex": r"[\\${`]", "markdown": r"[\[*_~`#\n|>]", "wiki": r"[\[{|=\n_]|''"}
_FAMILIES = {name: (re.compile(NEEDS[name]), [re.compile(p) for p in patterns]) for name, patterns in PATTERNS.items()}
#: Every alternative of the patterns above needs one of these characters, or two apostrophes; most texts hold one.
SIGNS = r"[<>&\\$*_`|~^#\[\]{}=%;:/\n]|''"

_BLOCK = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li list list-item main nav ol p para pre sec section summary table tbody td tfoot th thead title tr ul disp-formula disp-quote caption".split())
_VOID = frozenset("br hr img input link meta col wbr source param inline-graphic".split())
_SILENT = frozenset("script style head noscript iframe svg button select".split())
_CODE, _INLINE = frozenset("pre".split()), frozenset("code tt samp kbd monospace".split())
_FORMULA = frozenset("math tex-math".split())
_BULLETS = frozenset("li list-item".split())
_SIGNS = {"grave": "\u0300", "acute": "\u0301", "circ": "\u0302", "tilde": "\u0303", "uml": "\u0308"}
_ACCENTS = {"`": _SIGNS["grave"], "'": _SIGNS["acute"], "^": _SIGNS["circ"], "~": _SIGNS["tilde"], '"': _SIGNS["uml"], "=": "\u0304", ".": "\u0307", "c": "\u0327", "v": "\u030c", "u": "\u0306", "r": "\u030a"}


def markup_kinds(text: str | None) -> list[str]:
    """The families of markup that the text holds, whole, damaged or escaped; none for null and empty texts."""
    if not text:
        return []
    return [name for name, (needs, patterns) in _FAMILIES.items() if needs.search(text) and any(p.search(text) for p in patterns)]


class Node:
    """An element of the DOM with its counts: characters, tags, characters and tags of links below it."""

    __slots__ = ("chars", "children", "density", "link_chars", "link_tags", "name", "parent", "tags", "total")

    def __init__(self, name: str, parent: Node | None) -> None:
        self.name, self.parent, self.children = name, parent, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("body", None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        name = tag.rpartition(":")[2]
        if name in ("html", "body"):
            return
        if name in ("p", "li", "tr", "td", "th", "dt", "dd") and self.at.name == name:
            self.at = self.at.parent or self.root
        node = Node(name, self.at)
        self.at.children.append(node)
        if name not in _VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(Node(tag.rpartition(":")[2], self.at))

    def handle_endtag(self, tag: str) -> None:
        name, node = tag.rpartition(":")[2], self.at
        while node is not self.root and node.name != name:
            node = node.parent
        if node is not self.root:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def _walk(root: Node) -> list[Node]:
    """All nodes, each before its children; without recursion, as nesting may be deep."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return found


def densities(root: Node) -> None:
    """Composite text density of every node, and the sum of its children's."""
    order = _walk(root)
    for node in reversed(order):
        linked = node.name == "a"
        for c in node.children:
            if isinstance(c, Node):
                node.chars, node.tags = node.chars + c.chars, node.tags + c.tags + 1
                node.link_chars, node.link_tags = node.link_chars + c.link_chars, node.link_tags + c.link_tags
            elif node.name not in _SILENT:
                node.chars += len(c.strip())
        if linked:
            node.link_chars, node.link_tags = node.chars, node.tags + 1
    body = root.link_chars / max(1, root.chars)
    for node in order:
        c, t, lc, lt = node.chars, max(1, node.tags), node.link_chars, max(1, node.link_tags)
        if c == 0:
            continue
        base = math.log(c / max(1, c - lc) * lc + body * c + math.e)
        gain = max(1.0, c / max(1, lc) * t / lt)
        node.density = c / t * (math.log(gain) / math.log(base) if base > 1.0001 else math.log(gain + math.e))
    for node in order:
        node.total = sum(c.density for c in node.children if isinstance(c, Node))


def content(root: Node) -> tuple[Node, float]:
    """The root of the content and the density below which its branches are left out."""
    densities(root)
    if root.link_tags == 0:  # without links no branch is a side branch
        return root, 0.0
    best = max(_walk(root), key=lambda n: n.total)
    least, node = best.density, best
    while node is not None:
        least, node = min(least, node.density), node.parent
    return best, least


def _texts(node: Node) -> str:
    stack, parts = [node], []
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            parts.append(x)
        else:
            stack += list(reversed(x.children))
    return "".join(parts)


class _Kept:
    """Code and formulas, set aside under marks that no rewriting touches."""

    def __init__(self) -> None:
        self.parts: list[str] = []

    def put(self, part: str) -> str:
        self.parts.append(part)
        return f"\ue000{len(self.parts) - 1}\ue001"

    def back(self, text: str) -> str:
        # a part may hold marks of parts set aside before it
        while re.search("\ue000\\d+\ue001", text):
            text = re.sub("\ue000(\\d+)\ue001", lambda m: self.parts[int(m.group(1))], text)
        return text


def _render(root: Node, least: float, kept: _Kept) -> str:
    out: list[str] = []
    stack: list[object] = [root]
    while stack:
        x = stack.pop()
        if isinstance(x, tuple):
            out.append(x[0])
            continue
        if isinstance(x, str):
            out.append(x if x.strip() or "\n" not in x else " ")
            continue
        side = x.link_chars > 0 and x.density < least and x.name in _BLOCK
        if x.name in _SILENT or side:
            continue
        if x.name in _CODE:
            out.append("\n" + kept.put("```\n" + _texts(x).strip("\n") + "\n```") + "\n")
        elif x.name in _INLINE:
            out.append(kept.put("`" + _texts(x).strip() + "`"))
        elif x.name in _FORMULA:
            out.append(" " + kept.put("$" + re.sub(r"\s+", " ", _texts(x)).strip() + "$") + " ")
        elif x.name in ("br", "hr"):
            out.append("\n")
        else:
            before = after = "\n" if x.name in _BLOCK else ""
            if re.fullmatch("h[1-6]", x.name):
                before = "\n" + "#" * int(x.name[1]) + " "
            elif x.name == "title":
                before = "\n## "
            elif x.name in _BULLETS:
                before, after = "\n- ", ""
            elif x.name in ("td", "th"):
                before, after = " | ", ""
            stack.append((after,))
            stack += list(reversed(x.children))
            stack.append((before,))
    return "".join(out)


def _latex(text: str) -> str:
    text = re.sub(r"\\begin\{(equation|align|gather|eqnarray|displaymath|math)\*?\}(.*?)\\end\{\1\*?\}", r"$$\2$$", text, flags=re.S)
    text = re.sub(r"\\\[(.*?)\\\]", r"$$\1$$", text, flags=re.S)
    text = re.sub(r"\\\((.*?)\\\)", r"$\1$", text, flags=re.S)
    kept = re.split(r"(\$\$.*?\$\$|\$[^$\n]*\$)", text, flags=re.S)
    for i in range(0, len(kept), 2):
        s = kept[i]
        s = re.sub(r"\\begin\{verbatim\}(.*?)\\end\{verbatim\}", r"\n```\1```\n", s, flags=re.S)
        s = re.sub(r"\\(sub)*section\*?\{([^{}]*)\}", r"\n## \2\n", s)
        s = re.sub(r"\\item\b\s*", "\n- ", s)
        s = re.sub(r"~?\\(?:cite[a-z]*|ref|eqref|label|pageref)\*?(?:\[[^\]]*\])*\{[^{}]*\}?", "", s)
        s = re.sub(r"\\([`'^~\"=.cvur])\s*\{?\\?([a-zA-Z])\}?", lambda m: unicodedata.normalize("NFC", m.group(2) + _ACCENTS[m.group(1)]) if m.group(1) not in "cvur" or "{" in m.group() else m.group(), s)
        before = None
        while s != before:  # commands within commands, from the innermost on; each pass shortens the text
            before = s
            s = re.sub(r"\\(?:begin|end)\{[^{}]*\}", "\n", s)
            s = re.sub(r"\\[a-zA-Z]+\*?(?:\[[^\]]*\])?\{([^{}]*)\}", r"\1", s)
            s = re.sub(r"\{\\[a-zA-Z]+\s+([^{}]*)\}", r"\1", s)
        s = re.sub(r"([\^_])\{([^{}]*)\}", r"\1\2", s)
        kept[i] = re.sub(r"(?<=\w)~(?=\\)|\\[,;!]", " ", s).replace("\\%", "%").replace("\\&", "&").replace("\\$", "$").replace("\\#", "#").replace("\\_", "_")
    return "".join(kept)


def _wiki(text: str) -> str:
    text = re.sub(r"(?m)^(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$", lambda m: "#" * len(m.group(1)) + " " + m.group(2), text)
    text = re.sub(r"\{\|[^\n]*\n(.*?)\|\}", lambda m: re.sub(r"(?m)^(?:\|-.*|[|!]\s?)", "| ", m.group(1)), text, flags=re.S)
    text = re.sub(r"\[\[(?:Category|File|Image):[^\[\]]*\]\]", "", text)
    text = re.sub(r"\[\[(?!\s*-?\d+\s*,)(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", text)
    text = re.sub(r"\{\{(?!\s*[-\d{])[^{}]*\}\}", "", text)
    return re.sub(r"(?<![\d'])'{2,5}(?=[^\s'])([^'\n]+)'{2,5}", r"\1", text)


def _markdown(text: str) -> str:
    kept = re.split(r"(```.*?```)", text, flags=re.S)
    for i in range(0, len(kept), 2):
        s = re.sub(r"!\[([^\[\]\n]*)\]\([^()\n]*\)", r"\1", kept[i])
        s = re.sub(r"\[([^\[\]\n]+)\](?:\((?:https?://|www\.|/|#|mailto:|\.)[^\s)]*\)|\[[^\[\]\s,]*\])", r"\1", s)
        s = re.sub(r"(?m)^ {0,3}\[[^\]\n]+\]:[ \t]*\S+.*$", "", s)
        s = re.sub(r"(?<![\w*])(\*{1,3})(?=[^\s*])([^*\n]*[^\s*])\1(?![\w*])", r"\2", s)
        s = re.sub(r"(?<![\w_])(_{1,3})(?=[^\s_])([^_\n]*[^\s_])\1(?![\w_])", r"\2", s)
        s = re.sub(r"~~([^~]*)~~", r"\1", s)
        s = re.sub(r"(?m)^(\S[^\n]*)\n {0,3}(=|-){3,}[ \t]*$", lambda m: ("# " if m.group(2) == "=" else "## ") + m.group(1), s)
        kept[i] = re.sub(r"(?m)^ {0,3}[*+](?=[ \t]+\S)", "-", s)
    return "".join(kept)


def clean_text(text: str | None) -> str | None:
    """The text without markup; headings, lists, code and formulas are kept in the signs of Markdown and TeX.

    Null stays null and empty stays empty; a text without markup comes back as it is. Very long texts are handled
    whole. Comments, scripts, citations and reference marks are dropped.
    """
    kinds = markup_kinds(text)
    if not kinds:
        return text
    # private marks of the text itself would be taken for those used here
    text = re.sub("[\ue000\ue001]", "\ufffd", text)
    kept = _Kept()
    text = re.sub(r"(?s)```.+?```|(?m:^~~~[^\n]*$).+?(?m:^~~~[ \t]*$)|`[^`\n]+`(?!')", lambda m: kept.put(m.group()), text)
    text = re.sub(r"(?s)\\begin\{verbatim\}(.*?)\\end\{verbatim\}", lambda m: "\n" + kept.put("```" + m.group(1) + "```") + "\n", text)
    while True:  # until nothing is escaped; each pass shortens the text
        plain = re.sub(r"&(?:amp;)+", "&amp;", text)
        plain = re.sub(r"\\u003([ce])", lambda m: "<" if m.group(1) in "cC" else ">", plain, flags=re.I)
        plain = re.sub(r"(?i)%3c(?=[\w/])", "<", plain)
        plain = re.sub(r"(?i)(?<=[\w/])%3e", ">", plain)
        plain = re.sub(r"(?<![\w&;])((?:amp;)*(?:lt|gt|quot|nbsp|apos|#\d{3,5});)", r"&\1", plain) if "reference" in kinds else plain
        plain = html.unescape(plain)
        if plain == text:
            break
        text = plain
    if "html" in kinds or re.search(r"</?[a-zA-Z]", text):
        # a comparison of one-letter names is no tag: nothing in it is an attribute
        text = re.sub(r"<([a-z]\s+[^\s<>=/][^<>=]*)>", r"&lt;\1&gt;", text)
        text = re.sub(rf"(?i)<\s+(/?)\s*({_N})\s*(/?)\s*>", r"<\1\2\3>", text)
        text = re.sub(rf"(?i)(?<![\w</:])(/?{_N}\s?/?>)(?!>)", r"<\1", text)
        text = re.sub(rf"(?i)(</?{_N})(?=\s+[^<>=]*(?:<|$))", r"\1>", text)
        text = re.sub(rf"(?i)<(?!/?[a-z!?])|<(?!/?(?:{_N})\b|/?[a-z]+[:-]|!|\?|/)", "&lt;", text)
        builder = _Builder()
        builder.feed(text)
        builder.close()
        text = _render(*content(builder.root), kept)
    if re.search(r"[\\${]|[\^_]\{", text):
        text = _latex(text)
    text = _markdown(_wiki(text))
    text = re.sub(r"[ \t\u00a0]+", " ", text)
    return kept.back(re.sub(r"\s*\n\s*\n\s*", "\n\n", re.sub(r" *\n *", "\n", text)).strip())


def clean_texts(texts: DataFrame, column: str = "text") -> DataFrame:
    """`texts` with `clean_text` and `markup` (families found, an empty list for none) for its text column.

    Nulls keep null; other columns pass through, so columns of these two names must not be present in `texts`.
    """
    given = texts.withColumn("_touched", F.coalesce(F.col(column).rlike(SIGNS), F.lit(False)))
    plain = given.where(~F.col("_touched")).drop("_touched").withColumn("clean_text", F.col(column)).withColumn("markup", F.array().cast("array<string>"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            kinds = [markup_kinds(t) for t in frame[column]]
            frame["clean_text"] = [clean_text(t) if k else t for t, k in zip(frame[column], kinds, strict=True)]
            frame["markup"] = kinds
            yield frame

    marked = given.where("_touched").drop("_touched")
    return plain.unionByName(marked.mapInPandas(run, plain.schema))
