"""HTML sittings as turns, rule by rule, and the reader's flags."""

import pytest

from turnstone.operators.transcript import Para, label_at, opening_label, turns, turns_of
from turnstone.sources.html import decoded, paragraphs_of


def para(markup):
    return Para.of(paragraphs_of(markup)[0])


@pytest.mark.parametrize(
    "markup,label,speech",
    [
        ("<b>Sr. Quiroz. -- </b>Pido la palabra.", "Sr. Quiroz", "Pido la palabra."),
        ("<b>Sr. Presidente </b>(Ibarrola)<b>. -- </b>Se vota.", "Sr. Presidente (Ibarrola)", "Se vota."),
        ("<b>Sr. PRESIDENTE (Ibarrola</b>).- Queda aprobada", "Sr. PRESIDENTE (Ibarrola)", "Queda aprobada"),
        ("<b>Sr. President</b>e (Ibarrola). -- Tiene la palabra", "Sr. Presidente (Ibarrola)", "Tiene la palabra"),
        ("<b>Sr. PRESIDENTE.- </b>(Ibarrola).- Tiene la palabra", "Sr. PRESIDENTE (Ibarrola)", "Tiene la palabra"),
        ("<b>Sr. QUIROZ. Si</b> no le daban mandato", "Sr. QUIROZ", "Si no le daban mandato"),
        ("<b>Sr. QUIROZ.</b> Si no le daban mandato", "Sr. QUIROZ", "Si no le daban mandato"),
        ("<b>QUIROZ MENA.- </b>Gracias", "QUIROZ MENA", "Gracias"),
        ("<b>Sr. LÓPEZ-ARCE.- </b>Gracias", "Sr. LÓPEZ-ARCE", "Gracias"),
        ("El <b>señor</b> senador habla - dijo", None, None),
    ],
)
def test_labels(markup, label, speech):
    p = para(markup)
    found = opening_label(p)
    assert (found and found.name) == label
    if label:
        assert p.chars[found.speech :].strip() == speech


SITTING = """<h1>Cámara</h1><p>Masthead<hr>
<multicol><p>PRESENTES: nobody</multicol>
<center><b>1</b></center><center><b>Homenaje</b></center>
<p><b>Sr. Presidente </b>(Ibarrola)<b>. -- </b>Se abre el acto.
<p>Sigue hablando.
<p><i>-- Se practica la votación.</i>
<p>Queda aprobado.<b>Sr. QUIROZ.- </b>Gracias, señor.
<p><i>-- El texto es el siguiente:</i>
<p><font size="-1">Un documento impreso.</font>
<p>Señor presidente: vuelvo.
<p><a href="#s">[Volver al sumario]</a>
<p>En primer lugar anuncio. <i>(Aplausos prolongados en las bancas y en las galerías.)</i>
<p>Ana Duarte
<p>Directora del Cuerpo de Taquígrafos"""


def test_turns():
    rows, titles = turns_of(SITTING)
    got = [(r["type"], r["turn_id"], r["speaker_raw"], r["event_type"], r["text"]) for r in rows]
    assert titles == {"1": "1 Homenaje"}
    assert got[0][0] == got[1][0] == "furniture"
    assert ("heading", None, None, None, "Homenaje") in got
    assert ("speech", 1, "Sr. Presidente (Ibarrola)", None, "Se abre el acto. Sigue hablando.") in got
    assert ("event", None, None, "vote", "-- Se practica la votación.") in got
    assert ("speech", 1, "Sr. Presidente (Ibarrola)", None, "Queda aprobado.") in got
    assert ("other", None, None, None, "Un documento impreso.") in got
    assert ("speech", 2, "Sr. QUIROZ", None, "Señor presidente: vuelvo.") in got
    assert ("event", None, None, "applause", "(Aplausos prolongados en las bancas y en las galerías.)") in got
    assert [g[0] for g in got[-2:]] == ["furniture", "furniture"]


def test_notes_in_speech():
    rows, _ = turns_of("<hr><p><b>Sr. PRESIDENTE (Ibarrola).- </b>Se va a votar. — Se practica la votación. Aprobado. — El texto es el siguiente: Artículo uno.<p>Más del texto.<p>Quedan aprobados los pliegos.")
    assert [(r["type"], r["text"]) for r in rows] == [("speech", "Se va a votar."), ("event", "— Se practica la votación."), ("speech", "Aprobado."), ("event", "— El texto es el siguiente:"), ("other", "Artículo uno. Más del texto. Quedan aprobados los pliegos.")]


def test_flags():
    one = lambda m: paragraphs_of(m)[-1]
    assert one("<hr><p>a<p>b")["after_rule"] and not one("<p>a")["after_rule"]
    assert one('<p style="text-align: CENTER">a')["center"] and not one('<p style="text-align: center">a<p>b')["center"]
    assert one("<h2>x</h2><h1>a</h1>")["center"] and one("<center>a</center>")["center"]
    assert one("<multicol><p>a</multicol>")["multicol"] and not one("<multicol>a</multicol><p>b")["multicol"]
    assert one("<p><font size=-1>abcdef</font> gh")["small"] and not one("<p><font size=-1>ab</font> cdefgh")["small"]
    assert one("<p><a>all of it</a>")["link_only"] and not one("<p><a>part</a> of it")["link_only"]
    assert one('<p><span style="font-weight: 700">a</span>')["runs"][0]["bold"]
    assert [r["text"] for r in one("<p><b>Sr. AVIL<font>Í</font>N</b> x")["runs"]] == ["Sr. AVILÍN", " x"]
    assert one("<p>a<sup>1</sup>b<title>t</title>")["runs"][0]["text"] == "ab"


def test_decoding():
    assert decoded(b'<meta charset="utf-8">\xc3\xb3') == '<meta charset="utf-8">ó'
    assert decoded(b"<meta charset=iso-8859-1>a \x97 b").endswith("a — b")
    assert decoded(b"\xf3") == "ó" and decoded(b"<meta charset=nonsense>\xf3").endswith("ó") and decoded(None) is None
    assert decoded(b'<font face="Courier New">)</font>Qu\xe9?') == '<font face="Courier New">¿</font>Qué?'


def test_one_bad_document_is_its_own(spark):
    df = spark.createDataFrame([(1, SITTING), (2, None), (3, "")], "page_id long, html string")
    got = turns(df, "page_id", "html").collect()
    assert {r["page_id"] for r in got} == {1} and all(r["error"] is None for r in got)
    assert [r["seq"] for r in sorted(got, key=lambda r: r["seq"])] == list(range(len(got)))
