"""Every site rule reads a page built from the rule's own paths: the
selectors, class strings, direct-child flags, date attributes, markers and
positions of the rule table are consistent with the walker."""

import pytest

from tidepool.operators.html_extract import DEFAULT_BODY_TAGS, SITE_RULES, extract_one


def _open(step):
    attrs = ""
    if step.get("id"):
        attrs += f' id="{step["id"]}"'
    if step.get("cls"):
        attrs += f' class="{step["cls"]}"'
    return f"<{step['tag'] or 'div'}{attrs}>", f"</{step['tag'] or 'div'}>"


class _Tree:
    """Pages are built by merging paths: steps equal to an existing one at
    the same level share that element, as on a real page."""

    def __init__(self, step=None):
        self.step, self.kids, self.html = step, [], ""

    def add(self, path, leaf_html, leaf_attrs=""):
        node = self
        for i, step in enumerate(path):
            last = i == len(path) - 1
            nxt = None if last else next((k for k in node.kids if k.step == step), None)
            if nxt is None:
                nxt = _Tree(step)
                node.kids.append(nxt)
            node = nxt
        node.html, node.attrs = leaf_html, leaf_attrs

    def render(self):
        inner = "".join(k.render() for k in self.kids) + self.html
        if self.step is None:
            return inner
        o, c = _open(self.step)
        if getattr(self, "attrs", ""):
            o = o[:-1] + self.attrs + ">"
        return o + inner + c


def page_for(rule):
    tree = _Tree()
    title = f"Title of {rule['site']}"
    tree.add(rule["title_path"], title)
    tags = rule.get("body_tags") or DEFAULT_BODY_TAGS
    tree.add(rule["body_path"], "".join(f"<{t}>para {i}</{t}>" for i, t in enumerate(tags[:2])))
    date = None
    if rule.get("date_path"):
        raw = "2020-03-25T20:07:28+00:00"
        for _ in range(rule.get("date_nth") or 0):
            tree.add(rule["date_path"], "other")
        if rule.get("date_attr"):
            tree.add(rule["date_path"], "x", f' {rule["date_attr"]}="{raw}"')
        else:
            mark = f'early<{rule["date_after_tag"]}>' if rule.get("date_after_tag") else ""
            tree.add(rule["date_path"], mark + (rule.get("date_after") or "") + raw)
        date = raw
    if rule.get("next_path"):
        label = rule.get("next_text") or "more"
        if rule.get("next_child"):
            o, c = _open(rule["next_child"][-1])
            label = o + c
        tree.add(rule["next_path"], label, ' href="/page-2"')
    items = "".join(item(rule, i) for i in range(1, 4))
    body = tree.render()
    if rule.get("item_scope") and rule["item_scope"] == (rule.get("next_path") or [])[:-1]:  # one element holds both
        o, _ = _open(rule["item_scope"][0])
        return "<html><body>" + body.replace(o, o + items, 1) + "</body></html>", title, tags, date
    for step in reversed(rule.get("item_scope") or []):
        o, c = _open(step)
        items = o + items + c
    return "<html><body>" + body + items + "</body></html>", title, tags, date


def item(rule, i):
    """One listing item: its container with the link in it."""
    html = f"item {i}"
    for k, step in enumerate(reversed(rule["item_path"])):
        o, c = _open(step)
        html = (o[:-1] + f' href="/item-{i}">' if k == 0 else o) + html + c
    return html


@pytest.mark.parametrize("rule", SITE_RULES, ids=[r["site"] for r in SITE_RULES])
def test_rule_reads_its_own_page(rule):
    html, title, tags, date = page_for(rule)
    got_title, content, got_date, nxt, items, cards = extract_one(html, rule)
    assert [i for i in items if i.startswith("/item-")] == ["/item-1", "/item-2", "/item-3"]
    assert [c[0] for c in cards] == items
    if rule.get("next_path"):
        assert nxt == "/page-2"
    assert got_title is not None and title in got_title
    lines = content.split("\n")
    assert "para 0" in lines
    if rule.get("date_path"):
        assert got_date == date
