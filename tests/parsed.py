"""The HTML-to-text rule on top of the standard library's parser, for comparison."""

from html.parser import HTMLParser

from newsloom.functions.html import HIDDEN


class _TextNodes(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.buffer, self.hidden = [], [], []

    def close_node(self):
        node = "".join(self.buffer).strip()
        self.buffer = []
        if node:
            self.nodes.append(node)

    def handle_starttag(self, tag, attrs):
        self.close_node()
        if tag in HIDDEN:
            self.hidden.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.close_node()

    def handle_endtag(self, tag):
        self.close_node()
        if tag in self.hidden:
            while self.hidden.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.hidden:
            self.buffer.append(data)

    def handle_comment(self, data):
        self.close_node()

    handle_decl = handle_pi = handle_comment


def parse_text(fragment: str) -> str:
    parser = _TextNodes()
    parser.feed(fragment or "")
    parser.close()
    parser.close_node()
    return " ".join(parser.nodes)
