"""Display spans and spoilers of fragments."""

import random

from pagemill.operators import display


def spans(pages, *texts):
    """Per text: (disposition, kind, what it covers), in order, after checking that nothing is covered twice or not at all."""
    rows = display.projection(pages(*texts)).collect()
    out = []
    for i, text in enumerate(texts):
        own, at = sorted((r.start, r.end, r.disposition, r.kind) for r in rows if r.page_key == f"p{i}"), 0
        for start, end, *_ in own:
            assert start == at < end, (text, own)
            at = end
        assert at == len(text), (text, own)
        out.append([(d, k, text[a:b]) for a, b, d, k in own])
    return out


def only(found, disposition):
    return [t for d, _, t in found if d == disposition]


def test_arguments_and_nesting(pages):
    got = spans(
        pages, "派蒙：{{颜色|红|正文|未知=隐藏中文}}", "{{颜色|描述=a|描述=b|2=c}}", "{{折叠|标题=t|内容={{颜色|红|{{图标|n|x}} in}}}}", "{{odd|{{颜色|红|x}}|k={{odd}}}}",
        "{{#tag:ruby|a|style=b|z=c}}{{#tag:ref|a}}", "{{玩家名|{{x|y}}}} {{!}} {{切换板|开始}}", "", "plain only", "{{{x|y}}} z", "{{任务描述|描述=b|1=a}}")
    assert only(got[0], "visible") == ["派蒙：", "正文"] and only(got[0], "unsupported") == ["隐藏中文"] and ("metadata", "argument", "红") in got[0]
    assert only(got[1], "visible") == ["b"] and only(got[1], "unsupported") == ["a", "c"]
    assert only(got[2], "visible") == ["n", " in"] and only(got[2], "unsupported") == ["t"]
    assert only(got[3], "visible") == [] and only(got[3], "unsupported") == ["{{颜色|红|x}}", "{{odd}}"]
    assert only(got[4], "visible") == ["a"] and only(got[4], "unsupported") == ["c", "a"] and ("metadata", "argument", "b") in got[4]
    assert only(got[5], "visible") == ["{{玩家名|{{x|y}}}}", " ", " "] and ("metadata", "template", "{{切换板|开始}}") in got[5]
    assert got[6] == [] and got[7] == [("visible", "text", "plain only")]
    assert only(got[8], "unsupported") == ["{{{x|y}}}"] and only(got[8], "visible") == [" z"]
    assert only(got[9], "visible") == ["a"]


def test_links_tags_and_lines(pages):
    got = spans(
        pages, "[[a]] [[b|c {{颜色|红|d}}]] [[File:x.png|cap]] [[分类:y]]", "<b>x<i>y</i></b><br/><ref>z</ref><ref name=q /><rt>r</rt>", "<b>open only [[x", "== h ==\n* ''i'' [https://x.y l] &amp;\n----\n: z",
        "a<!--b-->c<nowiki>{{x|y}}</nowiki>", "<div><div>a</div>b</div></div>c", "{| x\n| a\n|}b", "<span style=\"a>{{颜色|红|x}}</span>")
    assert only(got[0], "visible") == ["a", " ", "c ", "d", " ", " "] and ("metadata", "media", "[[File:x.png|cap]]") in got[0] and ("metadata", "link_target", "b") in got[0]
    assert only(got[1], "visible") == ["x", "y"] and [k for _, k, t in got[1] if t.startswith("<ref")] == ["tag", "tag"]
    assert only(got[2], "visible") == ["<b>open only [[x"]
    assert [t.strip() for t in only(got[3], "visible") if t.strip()] == ["h", "i", "l", "&amp;", "z"] and ("metadata", "rule", "----") in got[3]
    assert only(got[4], "visible") == ["a", "c", "{{x|y}}"]
    assert only(got[5], "visible") == ["a", "b", "</div>c"]
    assert only(got[6], "visible") == ["b"] and got[6][0][1] == "table"
    assert "x" in only(got[7], "visible")


def test_signs_count_where_their_line_begins(pages):
    got = spans(pages, "<b>x</b>::", "a''b''----", "== h ==\t\nx", "a\r\n* b")
    assert only(got[0], "visible") == ["x", "::"] and only(got[1], "visible") == ["a", "b", "----"]
    assert only(got[2], "visible") == [" h ", "\nx"] and only(got[3], "visible") == ["a\r\n", " b"]


def test_any_text_is_covered_once(pages):
    rng = random.Random(11)
    signs = ["{{颜色|", "{{黑幕|", "{{odd|", "}}", "[[", "]]", "|", "=", "<b>", "</b>", "<ref>", "</ref>", "<!--", "-->", "''", "\n", "*", "==", "文", "a ", "{{{", "}}}", "{|", "|}", "<nowiki>", "</nowiki>", "[http://a b", "]", "描述="]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    spans(pages, *texts)


SPOILERS = [
    ("a{{黑幕|b}}", ["b"]), ("{{颜色|红|{{黑幕|b {{黑幕|c}}}}}}", ["b {{黑幕|c}}"]), ("{{颜色|{{黑幕|b}}|c}}", []), ("{{odd|{{黑幕|b}}}}", []), ("[[{{黑幕|b}}]] [[x|{{黑幕|c}}]]", ["b", "c"]),
    ("<b>{{黑幕|b}}</b><ref>{{黑幕|c}}</ref>", ["b"]), ("== {{黑幕|b}} ==\n{{黑幕|c}}", ["c"]), ("{{图标|{{黑幕|b}}}}", []), ("{{黑幕|1=a|1=b}}{{黑幕|x=c}}{{黑幕}}", ["b"]), ("", []),
]


def test_spoilers(pages):
    texts = [t for t, _ in SPOILERS]
    rows = display.spoiler_nodes(pages(*texts)).orderBy("page_key", "start").collect()
    for i, (text, want) in enumerate(SPOILERS):
        found = [r for r in rows if r.page_key == f"p{i}"]
        assert [text[r.value_start : r.value_end] for r in found] == want, text
        assert all(text[r.start : r.start + 4] == "{{黑幕" and text[r.end - 2 : r.end] == "}}" for r in found)
