"""A document that writes back what it read, byte for byte, but for what was edited.

Markup is kept as it was written; only the start tag of an element whose attributes
changed, and the texts that were set, are written anew.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.sax.saxutils import escape, unescape

MARKUP = re.compile(r"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<!DOCTYPE(?:[^\[>]|\[.*?\])*>|<(/?)([A-Za-z_][\w.:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
ATTRIBUTE = re.compile(r"([\w.:-]+)\s*=\s*(\"[^\"]*\"|'[^']*')")
NAMED = {"&quot;": '"', "&apos;": "'"}


def decode(raw: str) -> str:
    if "&" not in raw:
        return raw
    numbers = re.sub(r"&#(?:x([0-9A-Fa-f]+)|(\d+));", lambda m: chr(int(m[1], 16) if m[1] else int(m[2])), raw)
    return unescape(numbers, NAMED)


class Element:
    """An element; ``parts`` are raw texts and other markup (str) and elements, in document order."""

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, raw: str | None = None, closed: bool = False):
        self.tag, self.attrs, self.parts, self.parent = tag, dict(attrs or {}), [], None
        self._raw, self._closed, self._as_read = raw, closed, (tag, dict(self.attrs))
        self._end = f"</{tag}>"

    def get(self, name: str, default: str | None = None) -> str | None:
        return self.attrs.get(name, default)

    def children(self) -> list[Element]:
        return [p for p in self.parts if isinstance(p, Element)]

    def iter(self, *tags: str) -> Iterator[Element]:
        """This element and those below it, in document order."""
        ahead = [self]
        while ahead:
            e = ahead.pop()
            if not tags or e.tag in tags:
                yield e
            if e.parts:
                ahead += [p for p in e.parts[::-1] if isinstance(p, Element)]

    def find(self, path: str) -> Element | None:
        here = [self]
        for step in path.split("/"):
            here = [c for e in here for c in e.children() if c.tag == step]
        return here[0] if here else None

    def ancestors(self) -> Iterator[Element]:
        e = self.parent
        while e is not None:
            yield e
            e = e.parent

    @property
    def text(self) -> str:
        """Text before the first child."""
        out = []
        for p in self.parts:
            if isinstance(p, Element):
                break
            if not p.startswith(("<!--", "<?")):
                out.append(p[9:-3] if p.startswith("<![CDATA[") else decode(p))
        return "".join(out)

    @text.setter
    def text(self, value: str) -> None:
        first = next((i for i, p in enumerate(self.parts) if isinstance(p, Element)), len(self.parts))
        self.parts[:first] = [escape(value)] if value else []

    def all_text(self) -> str:
        return "".join(p.all_text() if isinstance(p, Element) else "" if p.startswith(("<!--", "<?")) else p[9:-3] if p.startswith("<![CDATA[") else decode(p) for p in self.parts)

    def write(self) -> str:
        inside = "".join(p.write() if isinstance(p, Element) else p for p in self.parts)
        if self._raw is not None and self._as_read == (self.tag, self.attrs) and not (self._closed and inside):
            return self._raw if self._closed else self._raw + inside + self._end
        attrs = "".join(f' {k}="{escape(v, {chr(34): "&quot;"})}"' for k, v in self.attrs.items())
        return f"<{self.tag}{attrs}>{inside}</{self.tag}>" if inside or (self._raw and not self._closed) else f"<{self.tag}{attrs}/>"

    # ---- edits that keep the indentation ----

    def _indent(self) -> str:
        for i, p in enumerate(self.parts):
            if isinstance(p, Element):
                before = self.parts[i - 1] if i and isinstance(self.parts[i - 1], str) else ""
                return before if before.strip() == "" else ""
        if self.parent is None:
            return "\n  "
        outer = self.parent._indent()
        return outer + "  " if outer else ""

    def append(self, child: Element) -> Element:
        child.parent = self
        space = self._indent()
        tail = self.parts[-1] if self.parts and isinstance(self.parts[-1], str) and self.parts[-1].strip() == "" else None
        if tail is not None and self.children():
            self.parts[-1:] = [space, child, tail]
        elif not self.children() and space:
            self.parts = [p for p in self.parts if not (isinstance(p, str) and p.strip() == "")] + [space, child, space[:-2] if space.endswith("  ") else space]
        else:
            self.parts.append(child)
        return child

    def insert_before(self, child: Element, before: Element) -> Element:
        child.parent = self
        at = next(i for i, p in enumerate(self.parts) if p is before)
        blank = self.parts[at - 1] if at and isinstance(self.parts[at - 1], str) and self.parts[at - 1].strip() == "" else self._indent()
        self.parts[at:at] = [child, blank] if blank else [child]
        return child

    def insert_after(self, child: Element, after: Element) -> Element:
        child.parent = self
        at = next(i for i, p in enumerate(self.parts) if p is after)
        self.parts[at + 1 : at + 1] = [self._indent(), child] if self._indent() else [child]
        return child

    def remove(self, child: Element) -> None:
        """With the blank before it; other text around it stays."""
        at = next(i for i, p in enumerate(self.parts) if p is child)
        first = at - 1 if at and isinstance(self.parts[at - 1], str) and self.parts[at - 1].strip() == "" else at
        del self.parts[first : at + 1]
        child.parent = None

    def order_children(self, children: list[Element]) -> None:
        """Put the same children into another order; blanks between them stay."""
        queue = iter(children)
        self.parts = [next(queue) if isinstance(p, Element) else p for p in self.parts]


class Document:
    """Prolog, root element and what follows it."""

    def __init__(self, root: Element, before: str, after: str, encoding: str, mark: bytes):
        self.root, self.before, self.after, self.encoding, self.mark = root, before, after, encoding, mark

    @classmethod
    def load(cls, data: bytes) -> Document:
        """Raises ``ValueError`` for what isn't well-formed."""
        mark = b"\xef\xbb\xbf" if data.startswith(b"\xef\xbb\xbf") else b""
        found = re.match(rb"<\?xml[^>]*encoding=[\"']([A-Za-z0-9._-]+)", data[len(mark) :])
        encoding = found[1].decode() if found else "utf-8"
        text = data[len(mark) :].decode(encoding)
        top = Element("#")
        stack, at = [top], 0
        for m in MARKUP.finditer(text):
            start, end = m.span()
            if start > at:
                stack[-1].parts.append(text[at:start])
            at, (slash, tag, rest) = end, m.groups()
            if tag is None:
                stack[-1].parts.append(m[0])
            elif slash:
                if len(stack) == 1 or stack[-1].tag != tag:
                    raise ValueError(f"unexpected end of {tag}")
                stack.pop()._end = m[0]
            else:
                closed = rest.rstrip().endswith("/")
                e = Element(tag, {k: decode(v[1:-1]) for k, v in ATTRIBUTE.findall(rest)} if rest else None, m[0], closed)
                e.parent = stack[-1] if stack[-1] is not top else None
                stack[-1].parts.append(e)
                if not closed:
                    stack.append(e)
        if at < len(text):
            stack[-1].parts.append(text[at:])
        roots = top.children()
        if len(stack) != 1 or len(roots) != 1 or any(isinstance(p, str) and "<" in p and not p.startswith("<") for p in top.parts):
            raise ValueError("not well-formed")
        i = next(k for k, p in enumerate(top.parts) if p is roots[0])
        return cls(roots[0], "".join(top.parts[:i]), "".join(top.parts[i + 1 :]), encoding, mark)

    def to_bytes(self) -> bytes:
        return self.mark + (self.before + self.root.write() + self.after).encode(self.encoding, "xmlcharrefreplace")

    # ---- views ----

    def components(self) -> list[tuple[Element, int]]:
        """Components in document order with their depth in the tree."""
        return [(e, sum(1 for _ in e.ancestors())) for e in self.root.iter("archdesc", "c")]

    def component(self, unitid: str) -> Element | None:
        return next((e for e, _ in self.components() if (u := e.find("did/unitid")) is not None and u.text.strip() == unitid), None)

    @staticmethod
    def dao_entries(component: Element) -> list[Element]:
        out = []
        for c in component.children():
            if c.tag == "dao":
                out.append(c)
            elif c.tag == "daogrp":
                out += [d for d in c.children() if d.tag in ("dao", "daoloc")]
        return out

    @staticmethod
    def term_entries(component: Element) -> list[Element]:
        ca = component.find("controlaccess")
        return ca.children() if ca is not None else []

    def known_roles(self) -> list[str]:
        return sorted({r for e in self.root.iter("dao", "daoloc") if (r := e.get("role"))})

    def known_sources(self) -> list[str]:
        from cartulary.operators.xmltree import TERMS

        return sorted({s for e in self.root.iter(*TERMS) if (s := e.get("source"))})
