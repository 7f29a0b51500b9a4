"""Pages to scopes: the only Python in the data path.

``read_page`` walks the tags of one page and lists, per scope (the page, an article,
a list item, a product box, a link), the elements that some extraction rule names.
It decides nothing: which element wins and how texts become fields are column
expressions in ``extract.py``.
"""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from html import unescape
from html.parser import HTMLParser
from operator import itemgetter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

SCOPE_TYPE = (
    "array<struct<kind:string,pos:int,in_section:boolean,in_main:boolean,text:string,link:string,"
    "has_kr:boolean,has_img:boolean,has_box:boolean,"
    "hits:array<struct<rule:string,pos:int,text:string,link:string,alt:string>>>>"
)
HIT_FIELDS = [(n, pa.int32() if n == "pos" else pa.string()) for n in ("rule", "pos", "text", "link", "alt")]
SCOPE_ROWS = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()), ("pos", pa.int32()), ("in_section", pa.bool_()), ("in_main", pa.bool_()),
            ("text", pa.string()), ("link", pa.string()), ("has_kr", pa.bool_()), ("has_img", pa.bool_()),
            ("has_box", pa.bool_()), ("hits", pa.list_(pa.struct(HIT_FIELDS))),
        ]
    )
)

# --- fixed values: elements without content, and those whose text is not shown ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(("script", "style", "template"))
# An open element of the second kind ends where one of the first kind starts.
ENDS_OPEN = {"li": ("li",), "p": ("p",), "option": ("option",), "tr": ("tr", "td"), "td": ("td",)}
# --- fixed values: class and attribute names of the shops' markup ----------------
BREADCRUMBS, PRODUCT_IMAGE, BOX_CLASS = "breadcrumbs", "ws-product-image", "ws-product-vertical"
LIST_CLASS, ITEM_CLASS = "ws-product-list-vertical", "ws-product-list-vertical__item"
PAGE_ATTR, TOTAL_ATTR, MORE_CLASS = "data-page", "data-total-pages", "ngr-button"
# --- fixed values: tags that stand around an element, outermost first -------------
AROUND_IMAGE = ("main", "div", "article", "div")
AROUND_LINK = ("main", "div", "section")
AROUND_ANY = frozenset((*AROUND_IMAGE, *AROUND_LINK))

# Tags that mean one thing to any reader of HTML; others are left to the base class.
# Attributes stand apart by blanks, with a value in quotes, without quotes, or none.
PLAIN_TAG = re.compile(
    r"<(?:/([a-zA-Z][a-zA-Z0-9]*)>"
    r"|([a-zA-Z][a-zA-Z0-9]*)"
    r"""((?:[ \t\n\r\f]+[a-zA-Z][-a-zA-Z0-9_:]*(?:=(?:"[^"]*"|'[^']*'|[^\s"'>=][^\s>]*))?(?=[ \t\n\r\f>]))*)"""
    r"[ \t\n\r\f]*>)"
)
PLAIN_ATTR = re.compile(r"""([a-zA-Z][-a-zA-Z0-9_:]*)(?:=("[^"]*"|'[^']*'|[^\s"'>=][^\s>]*))?""")
# What stands in these may be no markup, which ones differs between versions of the base class.
OWN_CONTENT = frozenset(
    ("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "plaintext", "xmp")
)
NONE = frozenset()
NAMED_TAGS = ("h3", "section")


class Node:
    """An element. Its text, "kr" texts and images are ranges over the page's.

    What rules ask about the elements around it is handed down as it is opened:
    ``inside`` names them, ``image_level`` and ``link_level`` count how far the tags
    of AROUND_IMAGE and AROUND_LINK have been met in order. Nothing walks upwards.
    """

    __slots__ = (
        "tag", "attrs", "classes", "up", "pos", "leads", "children", "start", "scope", "own", "inside",
        "image_level", "link_level",
    )

    def __init__(self, tag, attrs, up, pos, start):
        self.tag, self.attrs, self.up, self.pos, self.start = tag, attrs, up, pos, start
        named = attrs.get("class")
        self.classes = frozenset(named.split()) if named else NONE
        self.children = 0
        self.scope = None
        self.own = self.names() if named or tag in NAMED_TAGS else NONE
        if up is None:
            self.leads, self.inside, self.image_level, self.link_level = False, NONE, 0, 0
        else:
            self.leads = up.children == 0
            self.inside = up.inside | up.own if up.own else up.inside
            self.image_level, self.link_level = up.image_level, up.link_level
            if up.tag in AROUND_ANY:
                self.image_level = _next_level(up.image_level, up.tag, AROUND_IMAGE)
                self.link_level = _next_level(up.link_level, up.tag, AROUND_LINK)

    def names(self):
        """What this element is called by rules about elements inside it."""
        found = []
        if self.tag in NAMED_TAGS:
            found.append(self.tag)
        if self.tag == "div":
            if "price" in self.classes:
                found.append("div.price")
            if self.like("class", "product"):
                found.append("div~product")
        found += self.classes & {BREADCRUMBS, PRODUCT_IMAGE}
        return frozenset(found)

    def chain(self, *tags):
        """Whether the nearest parents are these, innermost first."""
        node = self.up
        for tag in tags:
            if node is None or node.tag != tag:
                return False
            node = node.up
        return True

    def has(self, *classes):
        return self.classes.issuperset(classes)

    def like(self, attr, part):
        return part in (self.attrs.get(attr) or "")


def _next_level(level, tag, tags):
    return level + (level < len(tags) and tags[level] == tag)


# Rules per job: tag ("*" for any) -> (rule name, test of the element and of the
# page's first elements by name). FIRSTS names those first elements; they are known
# inside them by their name with an @.
def _always(node, first):
    return True


LINK_RULE = {"a": [("link", lambda n, f: "href" in n.attrs)]}

BLOCKS = ("h2", "h3", "h4", "span", "div", "p")
SUBCATEGORY_RULES = {tag: [(tag, _always)] for tag in BLOCKS}

STORE1_PRODUCT_RULES = {
    "h2": [("name", _always)],
    "p": [
        ("info", lambda n, f: n.has("k-text-style--body-s")),
        ("unit.1", lambda n, f: n.has("k-text-style--label-s", "k-text-color--subdued")),
        ("unit.2", lambda n, f: n.has("k-text-style--label-s")),
        ("unit.3", lambda n, f: n.like("class", "subdued")),
        ("price.any", _always),
    ],
    "span": [
        ("price.1", lambda n, f: n.has("k-text-style--label-m", "k-text--weight-bold")),
        ("price.2", lambda n, f: n.has("k-text-color--default")),
        ("price.3", lambda n, f: "div.price" in n.inside),
        ("price.4", lambda n, f: n.like("class", "price")),
        ("price.5", lambda n, f: n.has("k-text-style--label-m")),
        ("unit.4", lambda n, f: n.like("class", "unit")),
        ("price.any", _always),
    ],
    "div": [("price.any", _always)],
    "img": [
        ("image.lead", lambda n, f: "@lead_div" in n.inside),
        ("image.div", lambda n, f: "@article_div" in n.inside),
        ("image.any", _always),
        ("image.1", lambda n, f: n.has("k-image", "k-image--contain")),
        ("image.2", lambda n, f: n.has("k-image")),
        ("image.3", lambda n, f: n.like("class", "product")),
        ("image.4", lambda n, f: n.like("alt", "product")),
        ("image.5", lambda n, f: n.chain("div", "article", "div", "div", "section")),
        ("image.6", lambda n, f: n.image_level == len(AROUND_IMAGE)),
        ("image.7", lambda n, f: "div~product" in n.inside),
    ],
}
FIRSTS = {
    "article": lambda n: n.tag == "article",
    "lead_div": lambda n: n.tag == "div" and n.leads and "@article" in n.inside,
    "article_div": lambda n: n.tag == "div" and "@article" in n.inside,
    "list": lambda n: n.tag == "ul" and n.has(LIST_CLASS),
}

PAGER_RULES = {
    "*": [("pager", lambda n, f: PAGE_ATTR in n.attrs)],
    "button": [("more", lambda n, f: n.has(MORE_CLASS))],
}
CARD_RULES = {
    **PAGER_RULES,
    "a": [
        ("link.1", lambda n, f: n.has("ws-product-vertical__link")),
        ("link.2", lambda n, f: "h3" in n.inside),
    ],
    "h3": [("title", lambda n, f: n.has("ws-product-vertical__title"))],
    "p": [
        ("subtitle", lambda n, f: n.has("ws-product-vertical__subtitle")),
        ("unit", lambda n, f: n.has("ws-product-vertical__price-unit")),
    ],
    "div": [
        ("price", lambda n, f: n.has("ws-product-vertical__price")),
        ("box", lambda n, f: n.has(BOX_CLASS)),
    ],
    "img": [("image", _always)],
    "ul": [("list", lambda n, f: n is f.get("list"))],
}

STORE2_PRODUCT_RULES = {
    "h1": [("name", _always)],
    "a": [("crumb", lambda n, f: BREADCRUMBS in n.inside)],
    "img": [("image.2", lambda n, f: PRODUCT_IMAGE in n.inside)],
    "*": [
        ("price.1", lambda n, f: n.attrs.get("itemprop") == "price"),
        ("price.2", lambda n, f: n.has("ws-product-price-regular")),
        ("info.1", lambda n, f: n.attrs.get("itemprop") == "description"),
        ("info.2", lambda n, f: n.has("ws-product-description")),
        ("image.1", lambda n, f: n.attrs.get("itemprop") == "image"),
        ("brand.1", lambda n, f: n.attrs.get("itemprop") == "brand"),
        ("brand.2", lambda n, f: n.has("ws-product-brand")),
    ],
}


def _article_scope(node, first):
    return "article" if node.tag == "article" else None


def _link_scope(node, first):
    return "link" if node.tag == "a" and "href" in node.attrs else None


def _card_scope(node, first):
    if node.tag == "div":
        return "box" if node.has(BOX_CLASS) else None
    if node.tag != "li":
        return None
    if node.has(ITEM_CLASS):
        return "item"
    return "listed" if "@list" in node.inside else "li"


# job -> (rules, scopes besides the page, named first elements, rules that the page
# itself is asked for: None is all)
JOBS = {
    "subcategories": (SUBCATEGORY_RULES, _link_scope, (), ()),
    "product_links": (LINK_RULE, _article_scope, (), None),
    "store1_product": (STORE1_PRODUCT_RULES, None, ("article", "lead_div", "article_div"), None),
    "cards": (CARD_RULES, _card_scope, ("list",), ("list", "pager", "more")),
    "pagination": (PAGER_RULES, None, (), None),
    "store2_product": (STORE2_PRODUCT_RULES, None, (), None),
}
# Of a rule's elements only those are kept that columns can ask for: the first whose
# text fits, all (without their text), or the first one or two.
PRICED, UNIT_PRICED = re.compile("kr|[0-9]"), re.compile(r"(?s)(?=.*/)(?=.*kr)")
KEEP_FITTING = {
    "price.any": re.compile(r"(?s)(?=.*kr)(?=.*[0-9])"),
    **{("store1_product", f"price.{i}"): PRICED for i in range(1, 6)},
    **{("store1_product", f"unit.{i}"): UNIT_PRICED for i in range(1, 5)},
}
KEEP_ALL = frozenset(("link", "image.any"))
KEEP_TWO = frozenset(("crumb",))


# job -> tag -> its rules and those for any tag
TESTS = {
    job: {tag: [*tests, *rules.get("*", [])] for tag, tests in rules.items()} for job, (rules, *_) in JOBS.items()
}


def plain_attrs(text):
    """The attributes of a plain tag; as in the base class, the last of a name counts."""
    found = {}
    for name, value in PLAIN_ATTR.findall(text):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        found[name.lower()] = unescape(value) if "&" in value else value
    return found


class PageReader(HTMLParser):
    """Collects the scopes and rule hits of one page in one pass over its tags."""

    def __init__(self, job):
        super().__init__(convert_charrefs=True)
        self.job = job
        self.rules, self.scope_of, self.firsts, self.page_rules = JOBS[job]
        self.any_tag = self.rules.get("*", [])
        self.tests = TESTS[job]
        self.first, self.scopes, self.around, self.texts, self.pending = {}, [], [], [], []
        self.open_tags = defaultdict(int)
        self.length = self.kr = self.imgs = self.count = 0
        self.node = Node("", {}, None, 0, (0, 0, 0))
        self.open_scope(self.node, "page")

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def goahead(self, end):
        """The base class's loop over texts and tags, with plain tags read by one pattern.

        A tag that is not plain, a comment or a declaration goes to the base class's
        method for it; what is cut off or no tag at all goes to its loop, with the rest.
        """
        page, i = self.rawdata, 0
        find, plain_tag = page.find, PLAIN_TAG.match
        while self.cdata_elem is None:
            j = find("<", i)
            if j < 0:
                break
            if i < j:
                text = page[i:j]
                self.pending.append(unescape(text) if "&" in text else text)
                i = j
            plain = plain_tag(page, i)
            closed, tag, attrs = plain.groups() if plain else (None, None, None)
            if closed:
                self.handle_endtag(closed.lower())
                i = plain.end()
            elif tag and (tag := tag.lower()) not in OWN_CONTENT:
                self.open(tag, plain_attrs(attrs) if attrs else {})
                i = plain.end()
            else:
                k = self.read_other(page, i)
                if k < 0:
                    break
                i = k if self.cdata_elem is None else self.read_content(page, k)
        self.rawdata = page[i:]
        super().goahead(end)

    def read_other(self, page, i):
        """Where a tag that is not plain, comment or declaration at i ends; negative if it is cut off or none."""
        after = page[i + 1 : i + 2]
        if after == "/":
            return self.parse_endtag(i)
        if after.isascii() and after.isalpha():
            return self.parse_starttag(i)
        if after == "?":
            return self.parse_pi(i)
        if after == "!":
            return self.parse_comment(i) if page.startswith("<!--", i) else self.parse_html_declaration(i)
        return -1

    def read_content(self, page, i):
        """Leave a script or the like to the base class, up to the tag that may end it."""
        last = re.compile(rf"</\s*{self.cdata_elem}[^>]*>", re.I).search(page, i)
        if last is None:
            return i
        self.rawdata = page[i : last.end()]
        super().goahead(0)
        left, self.rawdata = len(self.rawdata), page
        return last.end() - left

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # no such section: skip the declaration, as browsers do
            return self.parse_bogus_comment(i)

    def open_scope(self, node, kind):
        node.scope = {"kind": kind, "node": node, "has_box": False, "hits": []}
        self.scopes.append(node.scope)
        self.around.append(node.scope)

    def end_text(self):
        """A tag, comment or declaration ends a text; its pieces are stripped as one."""
        if not self.pending:
            return
        data = "".join(self.pending)
        self.pending = []
        self.kr += "kr" in data
        shown = "" if self.node.tag in HIDDEN else data.strip()
        self.texts.append(shown)
        self.length += len(shown)

    def handle_starttag(self, tag, attrs):
        self.open(tag, {k: v or "" for k, v in attrs})

    def open(self, tag, attrs):
        if self.pending:
            self.end_text()
        if tag in ENDS_OPEN and self.node.tag in ENDS_OPEN[tag]:
            self.leave(self.node)
        self.count += 1
        node = Node(tag, attrs, self.node, self.count, (self.length, self.kr, self.imgs))
        self.node.children += 1
        self.imgs += tag == "img"
        for name in self.firsts:
            if name not in self.first and FIRSTS[name](node):
                self.first[name] = node
                node.own |= {"@" + name}
        kind = self.scope_of(node, self.first) if self.scope_of else None
        if kind:
            self.open_scope(node, kind)
        self.node = node
        self.open_tags[tag] += 1
        if tag in VOID:
            self.leave(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.pending:
            self.end_text()
        node = self.node if self.open_tags[tag] else None
        while node is not None:
            found = node.tag == tag
            node = node.up
            self.leave(self.node)
            if found:
                break

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self.end_text()
        self.kr += "kr" in data

    def handle_decl(self, decl):
        self.end_text()

    handle_pi = unknown_decl = handle_decl

    def leave(self, node):
        """Finish an element and offer it to every scope around it."""
        self.node = node.up
        self.open_tags[node.tag] -= 1
        if node.scope is not None:
            self.around.pop()
            self.close_scope(node)
        tag, classes = node.tag, node.classes
        tests = self.tests.get(tag, self.any_tag)
        found = [name for name, fits in tests if fits(node, self.first)] if tests else ()
        is_box = tag == "div" and bool(classes) and "product" in node.attrs["class"].lower()
        if found or is_box:
            span = (node.start[0], self.length)
            for scope in self.around:
                scope["has_box"] |= is_box
                wanted = None if scope["kind"] != "page" else self.page_rules
                scope["hits"] += [(node.pos, n, span, node) for n in found if wanted is None or n in wanted]

    def close_scope(self, node):
        start = node.start
        node.scope.update(
            pos=node.pos,
            in_section="section" in node.inside,
            in_main=node.link_level == len(AROUND_LINK),
            span=(start[0], self.length),
            link=node.attrs.get("href"),
            has_kr=self.kr > start[1],
            has_img=self.imgs > start[2],
        )

    def result(self):
        self.end_text()
        while self.node.up is not None:
            self.leave(self.node)
        self.close_scope(self.node)
        page = "".join(self.texts)
        for scope in self.scopes:
            a, b = scope.pop("span")
            scope["text"] = page[a:b] if scope["kind"] == "link" else None
            if scope["hits"]:
                scope["hits"] = list(hits_as_rows(scope["hits"], page, self.job))
            del scope["node"]
        return self.scopes


def hits_as_rows(hits, page, job):
    """A scope's hits in document order, as many of each rule as can be asked for."""
    times, failed = defaultdict(int), {}
    for pos, rule, (a, b), node in sorted(hits, key=itemgetter(0)):
        text = None
        if rule not in KEEP_ALL:
            if times[rule] >= (2 if rule in KEEP_TWO else 1):
                continue
            fits = KEEP_FITTING.get(rule) or KEEP_FITTING.get((job, rule))
            if fits and b <= failed.get(rule, -1):
                continue  # inside an element whose whole text doesn't fit
            text = page[a:b]
            if fits and not fits.search(text):
                failed[rule] = b
                continue
        times[rule] += 1
        if rule == "pager":
            link, alt = node.attrs.get(PAGE_ATTR), node.attrs.get(TOTAL_ATTR)
        else:
            link = alt = None
            if node.attrs:
                link = node.attrs.get("href" if node.tag == "a" else "src")
                alt = node.attrs.get("alt")
        yield {"rule": rule, "pos": pos, "text": text, "link": link, "alt": alt}


def read_page(html: str | None, job: str) -> list[dict] | None:
    """Scopes of one page, the page itself first; None for no markup."""
    if html is None:
        return None
    reader = PageReader(job)
    reader.feed(html)
    reader.close()
    return reader.result()


def scopes(html: Column | str, job: str) -> Column:
    """The scopes of each page; only the html column goes to Python, in Arrow batches.

    Declared non-deterministic so that no filter on a result is moved below the call:
    that would parse every page once for the filter and once more for the columns.
    """

    @F.arrow_udf(SCOPE_TYPE)
    def read(pages: pa.Array) -> pa.Array:
        return pa.array((read_page(page, job) for page in pages.to_pylist()), type=SCOPE_ROWS, size=len(pages))

    return read.asNondeterministic()(html)


# Ship this module's code with the function: executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
