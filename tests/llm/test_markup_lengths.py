import time

import pytest

from paperloom.llm import markup


def _langs(text):
    nodes = markup.analyse(text, markup._Wide(markup.model()))
    return sorted({markup.language(n, nodes) for n in nodes if n.on})


def _clean(text):
    return markup.convert(text, markup.analyse(text, markup._Wide(markup.model())))


ADDRESS = "https://example.org/" + "/".join(f"part{i}" for i in range(80))
FORMULA = r"x_i + \alpha y_j = \sqrt{n} "
LONG = "the effect of the treatment remained stable in all groups " * 8


@pytest.mark.parametrize("k", [1, 3, 5, 11, 30])
def test_formulas_of_any_length(k):
    assert _langs("We set $" + (FORMULA * k).strip() + "$ in all runs.") == ["latex"]
    assert _langs("We set \\[ " + FORMULA * k + " \\] in all runs.") == ["latex"]


@pytest.mark.parametrize(
    "text, langs, gone",
    [
        (f"See [the page]({ADDRESS}) for more.", ["markdown"], "https"), (f'See <a href="{ADDRESS}">the page</a> for more.', ["html"], "href"), (f"We found that **{LONG.strip()}** in most cases.", ["markdown"], "**"),
        (f"We found that '''{LONG.strip()}''' in [[Main page|most]] cases.", ["wiki"], "'''"), (f"We found that \\emph{{{LONG.strip()}}} in most cases.", ["latex"], "emph"), (f"[[{LONG.strip()}|the page]] is new.", ["wiki"], "|"),
        (f"# {LONG}\n\nIt is new. It has `code` in it.", ["markdown"], "`"),
    ],
)
def test_long_pieces(text, langs, gone):
    assert _langs(text) == langs
    assert gone not in _clean(text)


def test_tables_citations_and_notes_are_kept():
    assert "a | b\nc | d" in _clean("The table:\n\\begin{tabular}{ll}\na & b \\\\\nc & d \\\\\n\\end{tabular}\n")
    assert "1 | 2" in _clean("<table><tr><td>1</td><td>2</td></tr></table> The <i>values</i> are small.")
    assert _clean(r"It was \textbf{shown} before~\cite{ann2001}.") == "It was shown before [ann2001]."
    assert _clean(r"The \emph{word}\footnote{A remark on it.} is old.") == "The word (A remark on it.) is old."


#: Texts written by hand, none from the generator that the trees are fitted on.
BY_HAND = (
    ("Cells were kept at 37 °C & 5% CO2; p < 0.05 and n > 30 hold throughout.", []), ("The ratio a/b (see [3], p. 12) was 5*10 or 3^2.", []), ("Prices rose from $12 to $15 a unit; costs of $3 were ignored.", []), ("We used C++ and F#; the variable learning_rate_decay was 0.1.", []),
    ("<p>We <em>compare</em> two drugs.</p>", ["html"]), ("H<sub>2</sub>O and CO<sub>2</sub> were measured.", ["html"]), ("Smith &amp; Jones report a 5&nbsp;% rise.", ["html"]), ("<ul><li>first aim</li><li>second aim</li></ul>", ["html"]), ("Line one<br>line two<br/>line three", ["html"]),
    ("## Background\n\nWe compare **two** drugs.", ["markdown"]), ("- first aim\n- second aim\n- third aim", ["markdown"]), ("See the [protocol](https://a.org/p.pdf) and `run.sh`.", ["markdown"]), ("| a | b |\n|---|---|\n| 1 | 2 |", ["markdown"]), ("```r\nx <- c(1, 2)\n```", ["markdown"]),
    ("== History ==\n'''Ozone''' was found in [[1839]].", ["wiki"]), ("{{cite journal|title=A|year=2001}} Ozone is a gas.", ["wiki"]), ("''Homo sapiens'' lives in [[Africa|the south]].", ["wiki"]), ("{| class=\"wikitable\"\n! a !! b\n|-\n| 1 || 2\n|}", ["wiki"]),
    (r"We prove that $f(x) \le \frac{1}{n}$ for all $n$.", ["latex"]), (r"\section{Methods} As in \cite{knuth}, \textit{both} hold.", ["latex"]), ("\\begin{itemize}\n\\item one\n\\item two\n\\end{itemize}", ["latex"]), (r"The rate is 5\% and \emph{rising}.", ["latex"]), (r"\begin{equation} E = mc^2 \end{equation}", ["latex"]),
)


def test_texts_written_by_hand():
    wrong = [(t, want, got) for t, want in BY_HAND if (got := _langs(t)) != want]
    assert len(wrong) <= 1, wrong


@pytest.mark.parametrize("piece", ["[a ", "$x ", "<b ", "\\[ a ", "**a ", "{{a ", "<!-- a ", "`a ", "<pre> a ", "&lt;b "])
def test_unclosed_signs_take_bounded_time(piece):
    began = time.time()
    markup.parse(piece * 4000)
    assert time.time() - began < 8
