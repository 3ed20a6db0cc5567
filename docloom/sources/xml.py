"""XML documents to rows: blocks, relations and metadata, by catalogs.

A tree of unbounded depth is the one input that DataFrame operations cannot walk, so a document is parsed once,
in an Arrow-batched Python function, into one row of arrays that are exploded in the JVM. A document that
does not parse becomes a problem row instead of ending the run.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property
from xml.etree import ElementTree as ET

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..plans import catalogs as C
from ..shipping import ship

LABELS = None  # compiled on first use in a worker
META = (
    "dc_title: string, dc_language: string, dc_type: string, dc_description: string, doc_status: string, dc_subject: array<string>, dc_identifier: array<struct<scheme: string, value: string>>, "
    f"dc_creator: array<{S.PERSON}>, dc_contributor: array<{S.PERSON}>, dc_publisher: array<{S.PERSON}>, dc_date: map<string, string>, dc_rights: map<string, string>, dc_coverage: string"
)
_colon = lambda ddl: ", ".join(f"{a}: {b}" for a, b in (x.split(" ", 1) for x in _top(ddl)))


def _top(ddl: str) -> list[str]:
    """Top-level fields of a DDL string."""
    out, depth, part = [], 0, ""
    for ch in ddl:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append(part.strip())
            part = ""
        else:
            part += ch
    return [*out, part.strip()]


PARSED = f"path string, doc_id string, format string, error string, blocks array<struct<{_colon(S.BLOCK)}>>, relations array<struct<{_colon(S.RELATION)}>>, metadata struct<{META}>"


def split_label(text: str) -> tuple[str | None, str | None]:
    """(label, title) of a numbered heading; the Column version is functions.text.section_label."""
    from ..functions.text import LABEL_PATTERNS

    global LABELS
    if LABELS is None:
        # Python's own \s and \d are Unicode's, and its flags have no U
        LABELS = [re.compile(p.replace("(?sU)", "(?s)").replace("(?siU)", "(?si)")) for p in LABEL_PATTERNS]
    for p in LABELS:
        if m := p.match(text):
            return m[1].strip(), m[2].strip()
    return None, None


def text_of(el) -> str:
    if not len(el) and isinstance(el.tag, str):
        return (el.text or "").strip()
    return "".join(el.itertext()).strip()


def spaced(el) -> str:
    """An element's texts, each stripped, with single spaces between."""
    if not len(el) and isinstance(el.tag, str):
        return (el.text or "").strip()
    return " ".join(t.strip() for t in el.itertext() if t.strip())


def tag_of(el) -> str | None:
    return el.tag if isinstance(el.tag, str) else None


# --- transforms of elements; names are those of functions.transforms ---------------------------------------


def _below(el, tag: str):
    """The first element of the tag below el."""
    return next((x for x in el.iter(tag) if x is not el), None)


def _dmcode(el):
    return el if tag_of(el).endswith("dmCode") else _below(el, "dmCode")


def dmc(el, tree) -> str:
    from ..functions.transforms import DMC_PARTS

    code = _dmcode(el)
    get = (code if code is not None else el).get
    body = "-".join(["DMC", *("".join(get(a, "") for a in part) for part in DMC_PARTS)])
    issue = None if tag_of(el).endswith("dmCode") else _below(el, "issueInfo")
    if issue is None and (up := tree.parent.get(el)) is not None:
        issue = _below(up, "issueInfo")
    number, work = (issue.get("issueNumber", ""), issue.get("inWork", "")) if issue is not None else ("", "")
    return f"{body}_{number}-{work}" if number and work else body


def applic_tree(el) -> dict:
    """The applicability expression: assert leaves under evaluate nodes of and / or, to any depth."""
    out: dict = {"applicId": el.get("id", "")}
    for d in el.iter("displayText"):
        if d is not el and (shown := d.find("simplePara")) is not None:
            out["displayText"] = text_of(shown)
            break

    top = el.find("evaluate")
    if top is not None:
        tree = out["evaluateTree"] = {"type": "evaluate", "andOr": top.get("andOr", "and"), "children": []}
        todo = [(top, tree["children"])]
        while todo:  # a node's children are listed before they are filled, so depth is bounded by memory
            el, held = todo.pop()
            for c in el:
                name = c.tag if isinstance(c.tag, str) else ""
                name = name if name in ("assert", "evaluate") else name.lower()
                if name == "assert":
                    held.append({"type": "assert", "ident": c.get("applicPropertyIdent", ""), "propType": c.get("applicPropertyType", ""), "values": c.get("applicPropertyValues", "")})
                elif name == "evaluate":
                    x = {"type": "evaluate", "andOr": c.get("andOr", "and"), "children": []}
                    held.append(x)
                    todo.append((c, x["children"]))
    return out


def _security(el, _) -> dict:
    parts = [el.get(n, "") for n in ("securityClassification", "commercialClassification", "caveat")]
    return {"accessRights": "public" if parts[0] == "01" and not parts[1] and not parts[2] else "restricted", "license": "_".join(filter(None, parts)) or "01"}


def _date(el, _) -> str | None:
    return f"{el.get('year')}-{el.get('month', '01').zfill(2)}-{el.get('day', '01').zfill(2)}" if el.get("year") else None


def _info_type(el, _) -> str:
    from ..functions.transforms import INFO_CODES

    code = _below(el, "dmCode") if tag_of(el).endswith("Ident") else el
    return INFO_CODES.get((code if code is not None else el).get("infoCode", "")[:3], "Procedure")


def _authors(els, _) -> list[dict]:
    names = [f"{e.findtext('.//given-names') or ''} {e.findtext('.//surname') or ''}".strip() for e in els]
    return [{"name": n, "entityType": "person"} for n in names if n]


ONE = {
    "dmc_assemble": lambda e, p: [{"scheme": "URI", "value": dmc(e, p)}], "dmc_from_dmref": dmc, "date_from_attrs": _date, "text_extract": lambda e, p: text_of(e) or None, "s1000d_security": _security,
    "s1000d_info_code_to_type": _info_type, "applic_tree": lambda e, p: applic_tree(e), "dmc_raw_fields": lambda e, p: dict(code.attrib) if (code := _dmcode(e)) is not None else {},
}
MANY = {"jats_author_name": _authors, "join_text": lambda els, p: "; ".join(filter(None, map(text_of, els))) or None}


#: a path that is looked up by tag, of elements with one attribute's value at most
BELOW = re.compile(r"\.//([^/\[\]*@.{}]+)(?:\[@([^/\[\]*@.{}='\"]+)='([^'\"]*)'\])?((?:/[^/\[\]*@.{}]+)*)")
#: paths as BELOW tells them apart, each once a process; made of catalogs, so they are few
PATHS: dict[str, tuple | None] = {}


def _told(path: str) -> tuple | None:
    if path not in PATHS:
        m = BELOW.fullmatch(path)
        PATHS[path] = m and (m[1], m[2], m[3], m[4].split("/")[1:])
    return PATHS[path]


#: tags of which a document must have one for a path to find anything, None where that is not known; by path and namespaces
NEEDED: dict[tuple, tuple | None] = {}
FIRST = re.compile(r"\.//([^/\[\]*@.{}]+)(?=[/\[]|\Z)")


def _needed(path: str, namespaces: tuple) -> tuple | None:
    if (path, namespaces) not in NEEDED:
        first = FIRST.match(path)
        NEEDED[path, namespaces] = (first[1],) if first else None if "/" in path else tuple(f"{{{ns}}}{path}" for ns in namespaces)
    return NEEDED[path, namespaces]


class Tree:
    """A document's elements, with what is looked up of them; each is made at its first use."""

    def __init__(self, root) -> None:
        self.root = root

    @cached_property
    def parent(self) -> dict:
        return {c: p for p in self.root.iter() for c in p}

    @cached_property
    def by_tag(self) -> dict[str, list]:
        """Elements below the root by tag, in document order: one walk for all rules."""
        out: dict[str, list] = {}
        elements = self.root.iter()
        next(elements)
        for e in elements:
            if e.tag in out:
                out[e.tag].append(e)
            else:
                out[e.tag] = [e]
        return out

    def findall(self, path: str) -> list:
        told = _told(path)
        if told is None:
            return self.root.findall(path)
        name, key, value, steps = told  # most rules: names below the root, and children of those
        found = self.by_tag.get(name, [])
        if key is not None:
            found = [e for e in found if e.get(key) == value]
        for step in steps:
            found = [c for e in found for c in e if c.tag == step]
        return found

    def find(self, path: str):
        told = _told(path)
        if told is None or "by_tag" in self.__dict__:
            return next(iter(self.findall(path)), None)
        name, key, value, steps = told  # of a few paths, the walk for each is cheaper than that for all tags
        for e in self.root.iter(name):
            if e is self.root or key is not None and e.get(key) != value:
                continue
            if not steps:
                return e
            found = [e]
            for step in steps:
                found = [c for e in found for c in e if c.tag == step]
            if found:
                return found[0]
        return None


# --- metadata rules ------------------------------------------------------------------------------------------


class Rules:
    """Applies a catalog's metadata rules to a tree and accumulates their values field by field."""

    def __init__(self, tree: Tree, namespaces=C.DC) -> None:
        self.tree, self.namespaces = tree, namespaces

    def elements(self, rule: dict) -> list:
        if "xpath" in rule:
            return self.find(rule["xpath"])
        return self.find(rule.get("dc_element", ""))

    def find(self, path: str) -> list:
        if "/" in path:
            return self.tree.findall(path)
        return next((found for ns in self.namespaces if path and (found := self.tree.by_tag.get(f"{{{ns}}}{path}"))), [])

    def value(self, rule: dict):
        if "static" in rule:
            return rule["static"]
        els = self.elements(rule)
        if not els:
            return None
        name = rule.get("transform")
        if name in MANY:
            return MANY[name](els, self.tree)
        if name in ONE:
            return ONE[name](els[0], self.tree)
        texts = [e.get(rule["attribute"]) for e in els] if "attribute" in rule else list(map(text_of, els))
        if "attribute" not in rule:
            # an element with only white space counts as found, with an empty text
            texts = [t for e, t in zip(els, texts) if e.text or t]
        else:
            texts = [t for t in texts if t]
        value = texts[0] if texts else None
        if value and "combine_with" in rule:
            other = self.find(rule["combine_with"])
            tail = text_of(other[0]) if other else ""
            value = f"{value}{rule.get('separator', ' ')}{tail}" if tail else value
        if value and "split_by" in rule:
            value = [s.strip() for s in value.split(rule["split_by"]) if s.strip()]
        if isinstance(value, str) and value and "truncate" in rule:
            value = value[: rule["truncate"]].lower()
        if isinstance(value, str) and value and "template" in rule:
            value = rule["template"].format(value=value)
        return value

    def shaped(self, field: str, rule: dict, value):
        """The value in the field's form: list of dicts, dict, or as it is."""
        dicts = isinstance(value, list) and all(isinstance(x, dict) for x in value)
        if field in ("dc_creator", "dc_contributor"):
            role = {"role": rule.get("role", "contributor")} if field == "dc_contributor" else {}
            return value if dicts else [{"name": value, "entityType": rule.get("entity_type", "organization"), **role}]
        if field == "dc_publisher":
            org = {"organizationType": rule["organization_type"]} if rule.get("organization_type") in S.ORG_TYPES else {}
            return value if dicts else [{"name": value, "role": rule.get("role", "publisher"), **org}]
        if field == "dc_identifier":
            return value if dicts else [{"scheme": rule.get("scheme", "URI"), "value": value}]
        if field in ("dc_date", "dc_rights"):
            if "dumb_down" in rule:
                return rule["dumb_down"].get(value, rule["dumb_down"].get("_default", {}))
            if "target_field" in rule:
                return {rule["target_field"]: value}
            return value if isinstance(value, dict) else {"issued": value} if field == "dc_date" else {}
        if field == "dc_coverage":
            return value if isinstance(value, dict) else {rule.get("target_field", "spatialCoverage"): value} if isinstance(value, str) else {}
        return value

    def apply(self, metadata: dict[str, list[dict]]) -> dict:
        out: dict = {}
        there = self.tree.by_tag.keys()
        for field, rules in metadata.items():
            for rule in rules:
                if "static" not in rule and (tags := _needed(rule["xpath"] if "xpath" in rule else rule.get("dc_element", ""), self.namespaces)) is not None and there.isdisjoint(tags):
                    continue
                raw = self.value(rule)
                if raw is None or (field == "dc_type" and rule.get("validate_enum") and raw not in S.DOC_TYPES):
                    continue
                new, old = self.shaped(field, rule, raw), out.get(field)
                if isinstance(old, list) and isinstance(new, list) and field in ("dc_creator", "dc_publisher", "dc_contributor", "dc_identifier"):
                    out[field] = old + new
                elif old and isinstance(old, dict) and isinstance(new, dict):
                    out[field] = {**old, **new}
                elif field == "dc_description" and isinstance(old, str) and isinstance(new, str):
                    out[field] = f"{old}{rule.get('join_separator', '; ')}{new}"
                else:
                    out[field] = new
        return out


def metadata_of(tree: Tree, format_id: str | None, formats: dict = C.FORMATS) -> dict:
    rules = Rules(tree)
    base = rules.apply(C.BASE)
    if format_id:
        own = rules.apply(formats[format_id]["metadata"])
        base |= {k: v for k, v in own.items() if v and k != "doc_status"}
    return base


# --- blocks --------------------------------------------------------------------------------------------------


JSON = json.JSONEncoder(ensure_ascii=False, check_circular=False).encode  # of what is made here, which holds no circles
ESCAPED = re.compile(r"[&<>]")
ESCAPED_VALUE = re.compile('[&<>"\r\n\t]')
#: children of a step that are more than text, and what a step holds that has none
STEP_PARTS = frozenset(("note", "warning", "caution", "proceduralstep", "reqcondno", "supportequipdescr", "torque"))
NOTHING_HELD = '"conditions": [], "actions": [], "acceptanceCriteria": []'
#: content rules by the catalog they were made of, which is kept with them
RULES: dict[int, tuple[dict, dict]] = {}


def _rules_of(format_id: str, formats: dict) -> dict[str, dict]:
    catalog = formats[format_id]
    if RULES.get(id(catalog), (None,))[0] is not catalog:
        RULES[id(catalog)] = catalog, C.content_rules(format_id, formats)
    return RULES[id(catalog)][1]


def _escape(m) -> str:
    return {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "\r": "&#13;", "\n": "&#10;", "\t": "&#09;"}[m[0]]


def fragment(top) -> str:
    """An element and the text after its end, as ElementTree writes them; to any depth. Qualified names, which need
    declarations, are left to ElementTree."""
    out: list[str] = []
    todo: list = [top]
    while todo:
        el = todo.pop()
        if isinstance(el, str):
            out.append(el)
            continue
        tag = el.tag
        if not isinstance(tag, str) or tag[:1] == "{":
            return ET.tostring(top, encoding="unicode")
        out += "<", tag
        for k, v in el.items():
            if k[:1] == "{":
                return ET.tostring(top, encoding="unicode")
            out += " ", k, '="', ESCAPED_VALUE.sub(_escape, v), '"'
        text, tail = el.text, el.tail
        tail = ESCAPED.sub(_escape, tail) if tail else ""
        if text or len(el):
            out.append(">")
            if text:
                out.append(ESCAPED.sub(_escape, text))
            if len(el):
                todo.append(f"</{tag}>{tail}")
                todo += reversed(el)
            else:
                out += "</", tag, ">", tail
        else:
            out += " />", tail
    return "".join(out)


class Shredder:
    """Blocks and relations of one document, in document order."""

    def __init__(self, root, doc_id: str, format_id: str | None, parts: tuple[str, ...] = ("lineage",), formats: dict = C.FORMATS, tree: Tree | None = None) -> None:
        self.tree, self.root, self.doc_id, self.format_id, self.formats = tree or Tree(root), root, doc_id, format_id, formats
        self.with_paths, self.with_fragments = ("lineage" in parts or p in parts for p in ("paths", "fragments"))
        self.steps: dict = {}  # of elements whose children were asked for: each child's step of a path
        self.paths: dict = {}
        self.applic_trees: dict[str, str | None] = {}
        self.with_relations = "relations" in parts or not {"blocks", "titles"} & set(parts)
        self.titles_only = "titles" in parts and not {"blocks", "relations"} & set(parts)
        self.rules = _rules_of(format_id, formats) if format_id else {}
        self.blocks: list[dict] = []
        self.relations: list[dict] = []
        self.count = 0

    @cached_property
    def applic(self) -> dict[str, object]:
        """The first applicability of each id."""
        first: dict[str, object] = {}
        for a in self.root.iter("applic"):
            first.setdefault(a.get("id"), a)
        return first

    def applic_json(self, ref: str) -> str | None:
        """The applicability's tree as JSON, written once for all steps that refer to it."""
        if ref in self.applic_trees:
            return self.applic_trees[ref]
        found, text = self.applic.get(ref), None
        if found is not None:
            tree = applic_tree(found)
            # texts alone are written one by one
            text = JSON(tree) if "evaluateTree" in tree else "{" + ", ".join([f'"{k}": {JSON(v)}' for k, v in tree.items()]) + "}"
        self.applic_trees[ref] = text
        return text

    def new_id(self) -> str:
        self.count += 1
        return f"{self.doc_id}-{self.count:06d}"

    def step_of(self, el) -> str:
        """An element's step of a path; an index only among siblings of the same tag. Siblings are counted once."""
        up = self.tree.parent.get(el)
        if up is None:
            return el.tag
        steps = self.steps.get(up)
        if steps is None:
            alike: dict[str, list] = {}
            for c in up:
                alike.setdefault(c.tag, []).append(c)
            steps = self.steps[up] = {c: tag if len(held) == 1 else f"{tag}[{n}]" for tag, held in alike.items() for n, c in enumerate(held, 1)}
        return steps[el]

    def path(self, el) -> str:
        """Absolute path; an ancestor's is made once."""
        way = []
        while el is not None and el not in self.paths:
            way.append(el)
            el = self.tree.parent.get(el)
        found = self.paths[el] if el is not None else ""
        for x in reversed(way):
            found = self.paths[x] = f"{found}/{self.step_of(x)}"
        return found

    def block(self, kind: str, text: str, el=None, **more) -> dict:
        b = {"page": 1, "block_type": kind, "text": text, "confidence": 1.0, "level": S.PARAGRAPH_LEVEL, "context_path": [], "parent_id": None, "block_id": more.pop("block_id", None) or self.new_id(), **more}
        if el is not None:
            if self.with_paths:
                b["source_xpath"] = self.path(el)
            if self.with_fragments:  # the fragment keeps the text after the element's end
                b["xml_fragment"] = fragment(el)
            if self.with_paths or self.with_fragments:
                b["source_element_name"] = el.tag
        return b

    def relate(self, kind: str, target: str, source=None, text=None, confidence: float = 1.0) -> None:
        self.relations.append({"source_block_id": source, "relation_type": kind, "target": target, "citation_text": text, "confidence": confidence})

    def run(self) -> None:
        if not self.format_id:
            text = "" if self.titles_only else text_of(self.root)
            self.blocks += [self.block("paragraph", text)] if text else []
            return
        catalog = self.formats[self.format_id]
        self.title(catalog)
        if self.titles_only:
            return
        for rule in catalog["relations"] if self.with_relations else ():
            for el in self.tree.findall(rule["xpath"]):
                if target := (ONE[rule["transform"]](el, self.tree) if rule.get("transform") in ONE else text_of(el)):
                    self.relate(rule["type"], target)
        if catalog["traverse"] == "jats_body":
            body = self.tree.find(".//body")
            if body is not None:
                self.walk(body, None, 1, [])
            refs = self.tree.find(".//ref-list")
            if refs is not None:
                self.blocks.append(self.block("section", "References", level=1))
                for ref in refs.iter("ref"):
                    self.relate("CITES", f"#{ref.get('id', '')}", text=text_of(ref))
            return
        content = self.tree.find(".//content")
        if content is not None:
            for tag in ("preliminaryRqmts", None, "closeRqmts"):
                if tag is None:
                    self.walk(content, None, 1, [])
                elif next(content.iter(tag), None) is not None:
                    self.requirements(content, tag)

    def title(self, catalog: dict) -> None:
        rule = next((r for r in catalog["metadata"].get("dc_title", []) if "xpath" in r), None)
        parts = []
        for path in filter(None, (rule["xpath"], rule.get("combine_with"))) if rule else ():
            el = self.tree.find(path)
            parts.append(text_of(el) if el is not None else "")
        text = (rule.get("separator", " ") if rule else "").join(p for p in parts if p)
        ident = self.tree.find(".//dmIdent") if self.format_id == "s1000d" else None
        fields = ONE["dmc_raw_fields"](ident, None) if ident is not None else {}
        if text or fields:
            self.blocks.append(self.block("title", text or "Untitled", level=0, structured_content=JSON({"s1000d_dmCode": fields}) if fields else None))

    def requirements(self, content, tag: str) -> None:
        el = next((c for p in content.iter("procedure") if p is not content and (c := p.find(tag)) is not None), None)
        if el is None:
            return
        # Elements that say that nothing of a kind is required.
        kinds = {"noconds": "condition", "nopersonnel": "personnel", "nosupportequips": "support_equipment", "nosupplies": "supplies", "nospares": "spares", "nosafety": "safety"}
        found = [kinds[t] for x in el.iter() if (t := (tag_of(x) or "").lower()) in kinds]
        structured = {"conditions": [{"type": k, "status": "none"} for k in found], "actions": [], "acceptanceCriteria": []}
        self.blocks.append(self.block("section", tag, el, level=1, structured_content=json.dumps(structured)))

    def walk(self, top, parent_id: str | None, level: int, path: list[str]) -> None:
        """Pre-order over an explicit stack, so that depth is bounded by memory and not by recursion."""
        todo = [(child, parent_id, level, path) for child in reversed(top)]
        while todo:
            el, parent_id, level, path = todo.pop()
            name = (tag_of(el) or "").lower()
            rule = self.rules.get(name) if name else None
            if not name:
                continue
            if rule is None:
                todo += [(c, parent_id, level, path) for c in reversed(el)]
                continue
            kind = rule["block"] or name
            if kind == "section":
                head = el.find(rule["title_child"]) if rule.get("title_child") else None
                text = text_of(head) if head is not None else "Untitled Section"
                label, title = split_label(text)
                b = self.block("section", text, el, level=level, parent_id=parent_id, context_path=path, section_label=label, section_title=title or text)
                self.blocks.append(b)
                todo += [(c, b["block_id"], level + 1, [*path, text]) for c in reversed(el)]
            elif kind == "procedureStep":
                self.step(el, parent_id, path, level)
            elif kind in ("table", "equation"):
                text = text_of(el)
                data = {"equation_data": {"latex": text, "equationNumber": None}} if kind == "equation" else {}
                self.blocks.append(self.block(kind, text, el, parent_id=parent_id, context_path=path, **data))
            elif (text := text_of(el)) or rule.get("keep_empty"):
                prefix = rule["prefix_template"].format(TAG=name.upper()) + " " if "prefix_template" in rule else rule.get("prefix", "")
                b = self.block(kind, prefix + text, el, parent_id=parent_id, context_path=path)
                self.blocks.append(b)
                for x in el.iter("xref"):
                    if x is not el and x.get("rid") and x.get("ref-type") == "bibr":
                        self.relate("CITES", f"#{x.get('rid')}", b["block_id"], x.text or "", 0.9)

    def step(self, top, parent_id: str | None, path: list[str], level: int) -> None:
        todo = [(top, parent_id, level)]
        while todo:
            el, parent_id, level = todo.pop()
            step_id = self.new_id()
            texts, notes, nested = [], [], []
            conditions, actions = [], []
            for child in el:
                name = (tag_of(child) or "").lower()
                if name not in STEP_PARTS:
                    if name:
                        texts.append(spaced(child))
                elif name in ("note", "warning", "caution"):
                    if text := spaced(child):
                        notes.append(self.block(name, text, child, parent_id=step_id, context_path=path))
                elif name == "proceduralstep":
                    nested.append(child)
                elif name == "reqcondno":
                    conditions.append({"type": "required_condition", "identifier": child.get("id", ""), "description": spaced(child)})
                elif name == "supportequipdescr":
                    conditions.append({"type": "support_equipment", "description": spaced(child)})
                elif name == "torque":
                    value, unit = child.findtext("torqueValue"), child.findtext("torqueUnit")
                    if value and unit:
                        try:
                            number = float(value)
                        except ValueError:  # kept as it is; the document is not lost for it
                            number = value
                        actions.append({"actionType": "tighten", "target": "bolt/fastener", "parameters": {"torqueValue": number, "torqueUnit": unit}})
                        texts.append(f"Torque: {value} {unit}")
            self.blocks += notes
            text = " ".join(filter(None, texts)).strip()
            if text or nested or conditions or actions:
                # as JSON writes the whole; most steps hold nothing
                held = f'"conditions": {JSON(conditions)}, "actions": {JSON(actions)}, "acceptanceCriteria": []' if conditions or actions else NOTHING_HELD
                if ref := el.get("applicRefId"):
                    held += f', "applicRefId": {JSON(ref)}'
                    if found := self.applic_json(ref):
                        held += f', "applicTree": {found}'
                self.blocks.append(self.block("procedureStep", text, el, block_id=step_id, level=level, parent_id=parent_id, context_path=path, structured_content=f"{{{held}}}"))
            else:  # an empty shell: what it held belongs to its parent
                for n in notes:
                    n["parent_id"] = parent_id
            todo += [(c, step_id, level + 1) for c in reversed(nested)]


BLOCK_FIELDS = [x.split(" ")[0] for x in _top(S.BLOCK)]
META_FIELDS = [x.split(":")[0].strip() for x in _top(META)]


def _person(x: dict) -> dict:
    return {k: x.get(k) for k in ("name", "entityType", "role", "affiliation", "organizationType")}


#: what a document is taken apart into; lineage is the blocks' paths, element names and fragments, of which "paths" and
#: "fragments" name one, with element names; "titles" are the title blocks alone
PARTS = ("blocks", "lineage", "relations", "metadata")


def parse(path: str, doc_id: str, data: bytes, parts: tuple[str, ...] = PARTS, formats: dict = C.FORMATS) -> dict:
    row: dict = {"path": path, "doc_id": doc_id, "format": None, "error": None, "blocks": [], "relations": [], "metadata": None}
    try:
        root = ET.fromstring(data)
    except (ET.ParseError, ValueError) as e:
        return row | {"error": str(e)}
    fmt = C.detect(root.tag, formats)
    row["format"] = fmt or "generic"
    tree = Tree(root)
    if "blocks" in parts or "relations" in parts or "titles" in parts:
        shredder = Shredder(root, doc_id, fmt, parts, formats, tree)
        shredder.run()
        for i, b in enumerate(shredder.blocks, 1):
            b["pos"] = i
        row["blocks"] = shredder.blocks if "blocks" in parts or "titles" in parts else []
        row["relations"] = shredder.relations if "relations" in parts else []
    if "metadata" in parts:
        row["metadata"] = _metadata_row(metadata_of(tree, fmt, formats))
    return row


def _metadata_row(meta: dict) -> dict:
    for k in ("dc_creator", "dc_contributor", "dc_publisher"):
        if meta.get(k):
            meta[k] = [_person(x) for x in meta[k]]
    if meta.get("dc_coverage"):
        meta["dc_coverage"] = json.dumps(meta["dc_coverage"], ensure_ascii=False)
    for k in ("dc_date", "dc_rights"):
        if meta.get(k) is not None:
            meta[k] = {a: str(b) for a, b in meta[k].items() if b is not None} or None
    return {n: meta.get(n) for n in META_FIELDS}


#: documents, and bytes of them, that are expanded at a time; a larger document is by itself
AT_ONCE, BYTES_AT_ONCE = 500, 8 << 20


def few(batch: pa.RecordBatch, column: str = "content") -> Iterator[pa.RecordBatch]:
    """A batch in slices of bounded numbers of rows and bytes."""
    start = held = 0
    for i, size in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if i > start and (i - start == AT_ONCE or held + (size or 0) > BYTES_AT_ONCE):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def shred(files: DataFrame, parts: tuple[str, ...] = PARTS, formats: dict = C.FORMATS) -> DataFrame:
    """files (path, doc_id, content: binary) -> one row a document: format, error, blocks, relations, metadata.
    Only ``parts`` are made; a Python stage does not see which of its columns are read, so it must be told.
    ``formats`` are the catalogs by name, those of a user (catalogs.from_yaml) among them."""

    ship(files.sparkSession)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(PARSED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in few(b):
                rows = [parse(p, d, c, parts, formats) for p, d, c in zip(*(part.column(n).to_pylist() for n in ("path", "doc_id", "content")))]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.select("path", F.col("doc_id").cast("string").alias("doc_id"), F.col("content").cast("binary").alias("content")).mapInArrow(run, PARSED)


def block_rows(files: DataFrame, columns: tuple[str, ...], parts: tuple[str, ...] = ("blocks",), formats: dict = C.FORMATS) -> DataFrame:
    """files -> (doc_id, *columns), a row a block: ``blocks(shred(files, parts))`` of these columns, which are all that is sent
    back from Python. Documents that do not parse have no rows."""
    ship(files.sparkSession)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    types = dict(x.split(" ", 1) for x in _top(S.BLOCK))
    ddl = ", ".join(["doc_id string", *(f"{c} {types[c]}" for c in columns)])
    schema = to_arrow_schema(_parse_datatype_string(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in few(b):
                ids: list = []
                values: list[list] = [[] for _ in columns]
                for doc_id, data in zip(*(part.column(n).to_pylist() for n in ("doc_id", "content"))):
                    found = parse("", doc_id, data, parts, formats)["blocks"]
                    ids += [doc_id] * len(found)
                    for c, held in zip(columns, values):
                        held += [x.get(c) for x in found]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip([ids, *values], schema)], schema=schema)

    return files.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("content").cast("binary").alias("content")).mapInArrow(run, ddl)


def blocks(parsed: DataFrame) -> DataFrame:
    return parsed.select("doc_id", F.explode("blocks").alias("b")).select("doc_id", "b.*")


def relations(parsed: DataFrame) -> DataFrame:
    return parsed.select("doc_id", F.explode("relations").alias("r")).select("doc_id", "r.*")


def metadata(parsed: DataFrame) -> DataFrame:
    return parsed.where("metadata is not null").select("doc_id", F.col("path").alias("source_path"), "metadata.*")


def problems(parsed: DataFrame) -> DataFrame:
    return parsed.where("error is not null").select(F.col("doc_id").alias("instance"), F.lit("xml-syntax").alias("type"), F.lit(400).alias("status"), F.col("error").alias("detail"))
