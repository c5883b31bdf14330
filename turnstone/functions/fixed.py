"""Values that must be as the records print them.

Fixed values throughout: word lists, patterns and codes of the chamber's transcripts,
stated as they are; the logic that uses them is elsewhere.  Patterns are in the dialect
that Java and Python share, in lower case where the text is folded first.
"""

from __future__ import annotations

# Kinds of a stenographer's note, in order; the first that is found in the lower-cased note names it.
EVENT_SUBTYPES = [
    ("timestamp", r"^[–—-]?\s*(?:a las|son las)\s+\d|^[–—-]?\s*en (?:la ciudad aut|buenos aires)"),
    ("vote", r"votaci[oó]n|se vota|resulta[n]?\s+(?:aprobad|rechazad)|afirmativ|negativ|unanimidad|asentimiento"),
    ("pause", r"luego de (?:unos )?instantes|cuarto intermedio|se reanuda"),
    ("applause", r"aplausos"),
    ("laughter", r"risas"),
    ("incident", r"manifestaciones|interrupci|abucheo|cánticos|murmullos|contenido no inteligible|fuera del alcance del micrófono|hablan a la vez|dialogan|interferencias|no se alcanza[n]? a (?:percibir|o[ií]r|escuchar)|se interrumpe la (?:transmisi|conexi)"),
    ("stage", r"ocupa la presidencia|ingresa|se retira|izamiento|entonaci|himno|arrían|puestos de pie"),
]

# A printed label's opening; a text that follows a note; the office's sign-off.
SPEAKER = r"^(?:(?i:Sr|Sra|Srta|Sres)(?:(?:[.\-]\s*)+|\s+)(?=[^\W\d_])|(?i:Varios|Varias|Un|Una)(?:\s+(?i:señores|señoras|señor|señora))?\s+(?i:senador))"
DOCUMENT_FOLLOWS = r"(?i)\b(?:es|son)\s+(?:el|la|los|las|lo)\s+siguientes?\s*(?::|\.?\s*\[?\s*$)"
SIGN_OFF = r"(?i)^\s*(?:Sub)?director[a]?\b[^\n]{0,60}?Taqu[íi]grafos"
READ_OUT = r"(?i)^[\W_]*(?:Se\s+lee|Lee)\b"
CHAIR_GOES_ON = r"^\s*(?:En consideración\b|Si no se hace uso de la palabra|Se van? a votar\b|Quedan? (?:aprobad|sancionad|levantada)|Aprobad[oa]s?\.|Como no hay más)"
SITTING_CLOSES = r"(?i)queda levantada la sesión|se levanta la sesión"

# Apparatus that is never spoken, and a second label inside a turn.
FURNITURE = {
    "stenographers' office": r"Direcci[óo]n General de Taquígrafos",
    "masthead": r"VERSI[ÓO]N TAQUIGR[ÁA]FICA|C[ÁA]MARA DE SENADORES DE LA NACI[ÓO]N",
    "sitting header": r"\d+[ªº°]\s*Reuni[óo]n\s*[-–]\s*\d+[ªº°]?\s*Sesi[óo]n",
    "presiding-officer block": r"Presidencia del se[ñn]or (?:vice)?presidente",
    "attendance roll heading": r"\bPRESENTES\b|\bAUSENTES\b",
    "appendix-pointer footnote": r"\bVer el Ap[eé]ndice\b",
    "contents link": r"\[\s*Volver al [Ss]umario\s*\]",
    "page-number dateline": r"\bPág\.+\s*\d{1,4}\b",
}
GLUED_LABEL = r"(?<![A-ZÁÉÍÓÚÑ])(?:Sr|Sra|Srta)\.\s+[A-ZÁÉÍÓÚÑ][^.]{1,45}?\.\s*(?:[–—−─]|--?)\s"

# Offices as labels print them, and openings of notes set without their dash.
OFFICES = "presidente presidenta vicepresidente vicepresidenta secretario secretaria prosecretario prosecretaria ministro ministra".split()
NOTE_OPENINGS = "Se |Varios |Varias |Ocupa |Ocupan |Puestos |Puestas |Son las |A las |Siendo las |Ingresa|Se retira|Aplausos|Risas|Murmullos|Manifestaciones|La votación|En particular|Así se hace|No se alcanza|Hablan"
ROLL_HEADINGS = "PRESENTES|AUSENTES|AUSENTE|EN COMISI[ÓO]N|SUSPENDIDO|SUSPENDIDOS|CON LICENCIA|LICENCIA"
EMBEDDED_KINDS = r"(?:Así se hace|Se\s+(?:lee|practica|práctica|vota|llama|continúa|reanuda)\b|La votación\b|En particular\b|Asentimiento\b|El resultado de la votación|(?:A|Son|Es)\s+la[s]?\s+\d|Luego de\b|Va\s?rios señores|Varias señoras|Murmullos|Manifestaciones|Aplausos|Risas|Contenido no inteligible|Ocupa(?:n)? la Presidencia|Puest[oa]s de pie|(?:El|La)\s+señor[a]?\s+senador[a]?\s[^.]{0,60}?\b(?:exhibe|muestra|realiza))"
MONTHS = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()
OPENING_DATE = r"a\s+las\s+[\d.,: ]+\s*(?:y\s*[\d]+\s*)?(?:horas?\s*)?del?\s+\w+\s+(\d{1,2})\s+de\s+(\w+)\s+de\s+(\d{4})"

# A symbol font's glyphs as one file draws them, and the years whose records are partial.
SYMBOLS = {"C": "—", "A": "“", "@": "”", ")": "¿", "(": "¡", "1": "°", "8": ""}
PARTIAL_YEARS = [1998, 1999, 2000, 2001, 2026]
# Names that declare Latin-1, which browsers read as windows-1252.
LATIN1 = "iso-8859-1 iso8859-1 latin-1 latin1 l1 iso-ir-100 8859-1 cp819".split()
# Reliability of an observation: whether it can stand, and what it is worth.
NEAR_DAYS, GRACE_DAYS = 200, 300
