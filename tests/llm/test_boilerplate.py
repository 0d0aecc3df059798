"""Pages of text. That furniture of a single page is told without its host was a matter of word lists; now every page stands among pages of its host."""

from plumbline.llm import boilerplate as bp

HEAD = "Your privacy matters. Together with our 3 partners we process data.\nAgree and close\nHome | Products | Contact | News\nProducts > Disposal > ABC-12D-3EFG\n"
BODY = "# Acme ABC-12D-3EFG hybrid inverter\nThe ABC-12D-3EFG sets one cookie; accept it.\nDisposal\nInput voltage: 1148 V\n| Weight | 3 kg |\nHome | Menu | Back are the three keys below the display.\n- The housing weighs 3 kg less than before.\n"
BOX = "Customers also viewed\nOther XYZ-77P-4QWE 500 W module\n\nAdvertisement\nThe Acme roof days: come and see us.\n"
TAIL = "1. It stays quiet at night.\nAll prices plus VAT and shipping.\n© 2026 Acme. All rights reserved.\nAcme, 3 Harbour Road, Hovsund\nImprint | Privacy | Terms of sale\nBack to top ↑"
PAGE = HEAD + BODY + BOX + TAIL
MAIN = {4, 5, 6, 7, 8, 9, 10, 16}


def verdicts(spark, pages):
    df = spark.createDataFrame([(i, u, c, "h", 1) for i, u, c in pages], "fetch_id bigint, url string, content string, host string, path int")
    return {(r.fetch_id, r.line_no): r.is_main for r in bp.line_verdicts(df).collect()}


def site(host, n=60, at=1000, consent="Your privacy matters. Together with our {} partners we process data.\nAgree and close", rest=TAIL.split("\n", 1)[1], boxes=("Customers also viewed\nOther XYZ-{}P-4QWE 500 W module", "Advertisement\nThe Acme roof days: come and see us.")):
    """Other pages of the host: the same furniture around other products, the boxes before, among and behind the main text."""
    pages = []
    for i in range(n):
        code = f"QRS-{i}D-3EFG"
        main = [f"# Acme {code} hybrid inverter", f"Unit {chr(97 + i % 26) * (1 + i // 26)} opens upwards without a tool.", "Disposal", f"The {code} weighs {i} kg.", f"Input voltage: {i} V", f"1. It stays quiet for {i} years.", f"The {code} is the last word on it."]
        for k, box in enumerate(boxes):
            main.insert((i + 3 * k) % 9, box.format(i))
        pages.append((at + i, f"https://{host}/p/{code.lower()}", "\n".join([consent.format(i), "Home | Products | Contact | News", *main, rest])))
    return pages


def test_page_among_pages_of_its_host(spark):
    got = verdicts(spark, [(1, "https://www.acme.example/p/abc-12d-3efg-7", PAGE), *site("acme.example")])
    assert {n for (i, n), main in got.items() if main and i == 1} == MAIN
    assert sum(i == 1 for i, _ in got) == sum(bool(x.strip()) for x in PAGE.split("\n"))


def test_odd_characters_do_not_hide_furniture(spark):
    odd = PAGE.replace("A", "А").replace("o", "о").replace("cookie", "соо\u200bkie")
    got = verdicts(spark, [(1, "https://acme.example/", odd), *site("acme.example")])
    assert {n for (i, n), main in got.items() if main and i == 1} == MAIN


def test_a_language_that_no_list_knows(spark):
    # Finnish furniture and text: only the host's pages say what is what
    page = "Käytämme evästeitä sivustolla.\nHyväksy kaikki\nKoti | Tuotteet | Uutiset\n# Acme ABC-12D-3EFG invertteri\nLaite on kevyt ja toimii yöllä aivan hiljaa.\nMainos\nTule messuille ja voita akku jo tänään.\nHuolto\nABC-12D-3EFG kestää talven hyvin.\nTilaa uutiskirje\nKaikki oikeudet pidätetään tässä.\nTakaisin ylös"
    others = site("acme.example", consent="Käytämme evästeitä sivustolla.\nHyväksy kaikki", rest="Tilaa uutiskirje\nKaikki oikeudet pidätetään tässä.\nTakaisin ylös", boxes=("Mainos\nTule messuille ja voita akku jo tänään.",))
    got = verdicts(spark, [(1, "https://acme.example/p/abc-12d-3efg", page), *others])
    assert {n for (i, n), main in got.items() if main and i == 1} == {3, 4, 7, 8}
    alone = verdicts(spark, [(1, "https://acme.example/p/abc-12d-3efg", page)])
    assert alone[1, 6] and not got[1, 6]  # without the host nothing tells the advertisement from the text


def test_consent_null_empty_and_long(spark):
    pages = [(1, "https://a.example/", "We use cookies\nAccept all"), (2, None, None), (3, "", ""), (4, "nonsense", " \n​\n"), (5, "https://a.example/", "word " * 50_000)]
    got = verdicts(spark, pages)
    assert {k for k, main in got.items() if not main} == {(1, 0), (1, 1), (5, 0)}
    assert verdicts(spark, []) == {}


def test_only_line_feeds_split_lines(spark):
    got = verdicts(spark, [(1, None, "Accept all\u2028x\x85y\r\nAccept all\r\n")])
    assert set(got) == {(1, 0), (1, 1)}


def test_votes_of_the_host_decide_open_lines(spark):
    # the same words on many pages of one host and nowhere else are furniture; elsewhere they are a heading
    pages = [(i, f"https://a.example/p/abc-1{i}d-3efg", f"ABC-1{i}D-3EFG\nThe ABC-1{i}D-3EFG is light and small.\nGreen corner\nIt runs at night without noise, as said.") for i in range(10, 30)]
    got = verdicts(spark, pages)
    assert not any(got[i, 2] for i in range(10, 30)) and all(got[i, 3] or got[i, 1] for i in range(10, 30))
    few = verdicts(spark, pages[:2])
    assert few[10, 2] and few[11, 2]


def test_main_text(spark):
    df = spark.createDataFrame([(1, "https://a.example/p/abc-12d-3efg", PAGE), (2, None, "Accept all"), (3, None, None), *site("a.example")], "fetch_id bigint, url string, content string")
    got = {r.fetch_id: r.main_text for r in bp.main_text(df).collect() if r.fetch_id < 1000}
    assert got == {1: "\n".join(x for n, x in enumerate(PAGE.split("\n")) if n in MAIN), 2: ""}


def test_repeated_lines_without_a_known_phrase_are_furniture(spark):
    # no list holds these words: the host's pages carry them, and another host's own sentence stays
    said = "Lorenz makes fine awnings for every balcony in the valley."
    pages = [(i, f"https://a.example/p/abc-1{i}d-3efg", f"ABC-1{i}D-3EFG\nThe ABC-1{i}D-3EFG is light and small.\nUnit {'qwertzuiop'[i % 10] * (i - 9)} runs at night without noise at all.\n{said}") for i in range(10, 30)]
    got = verdicts(spark, pages)
    assert not any(got[i, 3] for i in range(10, 30)) and all(got[i, 2] for i in range(10, 30))


def test_a_known_phrase_alone_is_no_verdict(spark):
    body = "ABC-12D-3EFG\nThe web server stores one cookie per session on the device.\nThe ABC-12D-3EFG is light and small."
    assert verdicts(spark, [(1, None, body)])[1, 1]


def test_pages_of_products_without_a_designation(spark):
    body = "The housing is modular and weighs less than before.\nIt runs at night without any noise at all."
    pages = [(1, "https://a.example/p/17", f"Home | Products | News\n# Primo 5.0\n{body}"), (2, "https://b.example/p/sunny-pv-42", f"Home | Products | News\nSunny PV-42\n{body}"), (3, "https://c.example/", body)]
    got = verdicts(spark, pages)
    assert {k for k, main in got.items() if main} == {(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (3, 0), (3, 1)}


def test_a_sentence_before_the_title_is_open(spark):
    pages = [(i, f"https://a.example/p/abc-1{i}d-3efg", f"{'We plan for you all of it, here and now.' if i != 50 else 'The lid of this unit opens upwards without any tool.'}\nABC-1{i}D-3EFG\nThe ABC-1{i}D-3EFG is light.") for i in range(10, 99)]
    got = verdicts(spark, pages)
    assert {k for k, main in got.items() if main and k[1] == 0} == {(50, 0)}


def test_the_share_of_pages_decides_at_every_size(spark):
    # a heading on 10 of 100 pages and on 40 of 400 is main text, one on 5 of 5 is furniture
    def shop(host, n, every, at):
        return [(at + i, f"https://{host}.example/p", f"ABC-12D-3EFG\nThe ABC-12D-3EFG is light.\n{'Green corner' if i % every == 0 else 'Own words ' + chr(97 + i % 26) * (1 + i // 26)}") for i in range(n)]

    for n in (100, 400):
        got = verdicts(spark, shop("a", n, 10, 0))
        assert all(got[i, 2] for i in range(n))
    got = verdicts(spark, shop("b", 5, 1, 0))
    assert not any(got[i, 2] for i in range(5))


def test_data_lines_with_changing_numbers_stay(spark):
    pages = [(i, f"https://a.example/p/abc-1{i}d-3efg", f"ABC-1{i}D-3EFG\nThe ABC-1{i}D-3EFG is light.\nWeight: {i} kg\nTel: 555 017") for i in range(10, 40)]
    got = verdicts(spark, pages)
    assert all(got[i, 2] and not got[i, 3] for i in range(10, 40))
