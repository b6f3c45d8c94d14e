"""Text of formulas, drawings, listings and elements that show inside ones that do not."""

import pytest

from plumbline.llm.html_text import page_text

CASES = [
    ("so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds", "so x=1 holds"),
    ("<math><semantics><mi>y</mi><annotation encoding=tex>\\y</annotation><annotation-xml><ci>z</ci></annotation-xml></semantics></math>!", "y!"),
    ("<math><mtable><mtr><mtd><mn>1</mn></mtd><mtd><mn>2</mn></mtd></mtr></mtable></math>", "1 2"),
    ("a<svg><title>t</title><desc>d</desc><metadata>m</metadata><rect/><g>no<text x=1>North <tspan>pole</tspan></text></g><text>South</text></svg>b", "a\nNorth pole\nSouth\nb"),
    ("<svg><desc/><text>kept</text></svg>", "kept"),
    ("<svg><defs><text>no</text></defs><foreignObject><p>html</p></foreignObject></svg>", "html"),
    ("<p>a<xmp>if <b> &amp;\n  x</xmp>c", "a\n\nif <b> &amp;\n  x\n\nc"),
    ("<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b>no</div>", "yes"),
    ("<span style='visibility:collapse'>no<i>no</i></span>yes", "yes"),
    ("<div style='display:none'>no<b style='visibility:visible'>no</b></div>yes", "yes"),
    ("<ul style='visibility:hidden'><li>no<li style='visibility:visible'>yes</ul>", "- yes"),
]


@pytest.mark.parametrize("source, text", CASES)
def test_pages(source, text):
    assert page_text(source) == text
