"""Visible text of generated trees whose words are known beforehand."""

import random
import re

import pytest

from plumbline.llm import html_text

INLINE = ("b", "i", "span", "em", "a href='/x'", "code", "u", "small")
BLOCKS = ("div", "p", "section", "h2", "blockquote", "ul", "ol", "table", "article")
HIDDEN = ("script", "style", "div hidden", "span style='display: none'", "template", "p style='visibility:hidden'", "head")


class Tree:
    """Writes a page and, beside it, its visible words; None stands where a line has to end between two words."""

    def __init__(self, seed):
        self.pick, self.n, self.want = random.Random(seed), 0, []

    def word(self, seen=True):
        self.n += 1
        if seen:
            self.want.append(f"w{self.n}")
        return f"w{self.n}"

    def inline(self, depth, seen=True):
        parts = []
        for _ in range(self.pick.randint(1, 4)):
            kind = self.pick.random()
            if kind < 0.6 or depth <= 0:
                parts.append(self.word(seen))
            elif kind < 0.9:
                tag = self.pick.choice(INLINE)
                parts.append(f"<{tag}>{self.inline(depth - 1, seen)}</{tag.split()[0]}>")
            else:
                parts.append(self.hidden())
        return " ".join(parts)

    def hidden(self):
        tag = self.pick.choice([x for x in HIDDEN if x not in ("head", "p style='visibility:hidden'", "div hidden")])
        return f"<{tag}>{self.word(False)} {self.word(False)}</{tag.split()[0]}><!-- {self.word(False)} -->"

    def block(self, depth):
        tag = self.pick.choice(BLOCKS)
        self.want.append(None)
        if tag in ("ul", "ol"):
            inner = ""
            for _ in range(self.pick.randint(1, 3)):
                inner += f"<li>{self.inline(1)}" + self.pick.choice(("</li>", ""))
                self.want.append(None)
        elif tag == "table":
            inner = ""
            for _ in range(self.pick.randint(1, 3)):
                inner += "<tr>" + "".join(f"<td>{self.inline(0)}" + self.pick.choice(("</td>", "")) for _ in range(2)) + self.pick.choice(("</tr>", ""))
                self.want.append(None)
        elif tag in ("p", "h2") or depth <= 0:
            inner = self.inline(2)
        else:
            inner = " ".join(self.block(depth - 1) if self.pick.random() < 0.6 else self.inline(2) for _ in range(self.pick.randint(1, 3)))
        self.want.append(None)
        return f"<{tag}>{inner}</{tag}>"

    def page(self):
        hidden = "".join(f"<{t}>{self.word(False)}</{t.split()[0]}>" for t in self.pick.sample(HIDDEN[:3], 2))
        body = " ".join(self.block(3) for _ in range(self.pick.randint(1, 6)))
        return f"<!doctype html><html><head><title>{self.word(False)}</title></head><body>{hidden}{body}</body></html>"


@pytest.fixture(scope="module")
def trees():
    made = []
    for seed in range(400):
        tree = Tree(seed)
        page = tree.page()
        made.append((page, tree.want, html_text.page_text(page)))
    return made


def test_all_visible_words_and_no_others(trees):
    for page, want, text in trees:
        assert re.findall(r"w\d+", text) == [w for w in want if w], page


def test_blocks_end_lines_and_inline_tags_do_not(trees):
    for page, want, text in trees:
        last, ended = None, False
        for w in want:
            if w is None:
                ended = True
                continue
            if last:
                between = text[re.search(rf"\b{last}\b", text).end() : re.search(rf"\b{w}\b", text).start()]
                assert ("\n" in between) == ended, (page, last, w, text)
            last, ended = w, False
