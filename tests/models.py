"""Small-step models of the text functions, written from their closed forms."""

BLANKS = "\t\n\v\f\r "


def clean(text):
    kept = "".join(c for c in text if c in BLANKS or " " <= c <= "~")
    out = []
    for c in kept:
        if c in BLANKS:
            if not out or out[-1] != " ":
                out.append(" ")
        else:
            out.append(c)
    return "".join(out)


def pieces(text):
    """Consecutive parts of the text before overlap is added."""
    sep = "\n\n" if "\n\n" in text else "\n"
    out, rest = [], text
    while rest:
        at = rest.find(sep)
        size = at + len(sep) if 0 <= at <= 1200 else 1000
        out.append(rest[:size])
        rest = rest[size:]
    return out


def chunks(text):
    parts = pieces(text)
    out = parts[:1]
    for before, part in zip(parts, parts[1:]):
        window = before[-200:] + part
        at = next((i for i, c in enumerate(window) if c in BLANKS), len(window))
        out.append(window[at:].lstrip(BLANKS))
    return out


def page_chunks(text):
    return [c for c in chunks(clean(text)) if len(c) >= 500]
