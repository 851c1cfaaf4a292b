"""A self-written release in the shape of the tabular XML, with the hard cases."""


def diag(code, desc, *children, note=None, extensions=()):
    rule = ""
    if note is not None:
        rule += f"<sevenChrNote><note>{note}</note></sevenChrNote>"
    if extensions:
        chars = "".join(f'<extension char="{c}">{t}</extension>' for c, t in extensions)
        rule += f"<sevenChrDef>{chars}</sevenChrDef>"
    return f"<diag><name>{code}</name><desc>{desc}</desc>{rule}{''.join(children)}</diag>"


def section(id_, desc, *children):
    return f'<section id="{id_}"><desc>{desc}</desc>{"".join(children)}</section>'


def chapter(name, desc, *sections, refs=()):
    index = "".join(f'<sectionRef first="{a}" last="{b}" id="{a}-{b}">{t}</sectionRef>' for a, b, t in refs)
    return (
        f"<chapter><name> {name} </name><desc>{desc}</desc><sectionIndex>{index}</sectionIndex>"
        f"{''.join(sections)}</chapter>"
    )


def release(version, *chapters):
    return (
        '<?xml version="1.0" encoding="utf-8"?>\n<ICD10CM.tabular>\n'
        f"<version>{version}</version>{''.join(chapters)}\n</ICD10CM.tabular>\n"
    )


SIDES = (("1", "right ear"), ("2", "left ear"))
VISITS = (("A", "first visit"), ("D", "Later visit"), ("S", "séquelle"))

FULL = release(
    "2031",
    chapter(
        "1",
        "Bones (L00-L99)",
        section(
            "L20-L29",
            "Brittle bones (old) (L20-L29)",
            diag(
                "L20",
                "Brittle bone",
                diag(
                    "L20.0",
                    "Brittle bone of age",
                    diag("L20.00", "Brittle bone of age, any site"),
                    diag("L20.01", "Brittle bone of age, arm", diag("L20.011", "Brittle bone of age, right arm")),
                ),
                note="to be added to each code from category L20:",
                extensions=VISITS,
            ),
            diag("L23", "Bent bone"),
            diag(
                "L25",
                "Broken bone",
                diag("L25.1", "Broken bone, <new>néw</new> type,", note="added to code L25.1", extensions=VISITS[:2]),
                note="added to each code from category L25",
                extensions=VISITS,
            ),
        ),
        section("L25-L30", "Broken things (L25-L30)"),
        refs=(("L20", "L29", "Brittle bones"), ("L25", "L30", "Broken things")),
    ),
    chapter(
        "2",
        "Necks and ears (M40-S12)",
        section(
            "M40-M49",
            "Ears (M40-M49)",
            diag("M12", "Early ear"),
            diag(
                "M40",
                "Ear trouble",
                diag(
                    "M40.1",
                    "Ear trouble, loud",
                    diag(
                        "M40.11",
                        "Ear trouble, very loud",
                        diag("M40.111", "Ear trouble, very loud, with pain"),
                        note="One of the following is to be assigned to codes in subcategory M40.11",
                        extensions=SIDES,
                    ),
                ),
            ),
            diag(
                "M41",
                "Ear growth",
                diag(
                    "M41.1",
                    "Ear growth, inner",
                    diag(
                        "M41.10",
                        "Ear growth, inner, plain",
                        diag(
                            "M41.101",
                            "Ear growth, inner, plain, side one",
                            diag("M41.1011", "Ear growth, inner, plain, side one, TOP"),
                        ),
                    ),
                ),
            ),
        ),
        section(
            "S10-S19",
            "Necks (S10-S19)",
            diag(
                "S12",
                "Neck break",
                diag("S12.0", "Neck break, first", diag("S12.00", "Neck break, first, any", diag("S12.000", "Neck break, first, any, shifted"))),
                diag("S12.8", "Neck break, other", note="added to code S12.8", extensions=VISITS),
                note="added to all codes from subcategories S12.0-S12.6",
                extensions=(("A", "closed"), ("B", "open")),
            ),
        ),
    ),
)

# Another year: the same rule text but other codes, an orphan, a too shallow code.
SMALL = release(
    "2032",
    chapter(
        "1",
        "Bones (L20-L99)",
        section(
            "L20-L29",
            "Brittle bones (L20-L29)",
            diag("L20", "Brittle bone", diag("L20.0", "Brittle bone of age")),
            diag(
                "L21", "Soft bone", diag("L21.0", "Soft bone, any", diag("L21.00", "Soft bone, odd nesting",
                diag("L21.555", "Orphan bone")), diag("L21.999", "Too shallow")),
            ),
        ),
    ),
)

BROKEN = "<ICD10CM.tabular><version>2033</version><chapter><name>1</name><desc>cut off"
