"""Surrogates for personal data and secrets, by DataFrame functions only.

One expression finds e-mail addresses, telephone numbers, card numbers, IP
addresses, social security and account numbers, keys, passwords and titled names.
Each is brought to a normal form, and SHA-256 over key, type and normal form yields
its surrogate: letters for letters, digits for digits, the check digit of a
card, octets in range, names of the gender that the title or else the given name tells, in the script of the name, and
the punctuation and case of the place it is put.  The surrogate depends on nothing
else, so an entity reads alike in all documents.

A titled name runs over all name words that follow, hyphens, apostrophes, particles and
initials included; each word is an entity.  The words of a document's titled names are
replaced wherever else the document has them, titled or not.

Collision check: the distinct entities of the whole corpus are grouped by
surrogate, and one that shares its surrogate with another, or whose surrogate is
itself an entity, is drawn again under the next attempt number, until none is
left.  Only documents that hold such an entity meet that list by a join; it is
empty unless two entities collide.  Distinct entities are summed up before the
shuffle, so one entity in a third of all documents is a few rows.

Null text stays null with no entities, repeated rows are treated alike, null ids
are kept, further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsmart.llm.common import stored

#: Collisions halve at least with each attempt; more rounds mean a type without room.
MAX_ATTEMPTS = 40

_TITLES = {
    "m": "Mr|Mister|Herrn|Herr|Monsieur|Señor|Sr|Sir|Lord|Don|Profesor|Господин|Κύριος|Καθηγητής",
    "n": "Dr|Doctor|Doktor|Docteur|Prof|Professor|Professeur|Rev|Доктор|Профессор|Δρ",
    "f": "Mrs|Ms|Miss|Madam|Lady|Frau|Fräulein|Madame|Mme|Mademoiselle|Mlle|Señora|Señorita|Srta|Sra|Doña|"
    "Dra|Profesora|Professorin|Госпожа|Κυρία",
}
_ANY_TITLE = "|".join(_TITLES.values())
#: Letters that a title begins with.
_INITIALS = "".join(sorted({t[0] for t in _ANY_TITLE.split("|")}))
_TITLED = rf"(?:(?:{_ANY_TITLE})(?:\.\s{{0,3}}|\s{{1,3}}))+"
_WORD = r"\p{Lu}[\p{L}\p{M}]+"
_CORE = rf"(?:\p{{Lu}}[\x27’])?{_WORD}(?:[\x27’-]{_WORD}|-\p{{Ll}}[\p{{L}}\p{{M}}]+)*+"
_BEFORE = r"(?:\p{Lu}\.[ -]?|(?:von|vom|van|der|den|de|del|della|di|da|dos|du|la|le|zu|zur|bin|ibn|al|el) |[dl][\x27’])*"
_RUN = rf"{_BEFORE}{_CORE}(?: {_BEFORE}{_CORE})*"
#: A word of a name with what stands before it; the words of a run, joined, are the run.
_PART = rf".*?(?:{_WORD}|(?<=-)\p{{Ll}}[\p{{L}}\p{{M}}]+|\p{{Lu}}(?=\.))"
#: A word that may be the later mention of a name.
_MENTION = rf"(?<![\p{{L}}\p{{M}}\p{{N}}]){_WORD}|(?<=\p{{L}}-)\p{{Ll}}[\p{{L}}\p{{M}}]+"
_SECRET = r"(?i:password|passwd|pwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\x22']?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

#: Patterns by type; the first that fits the place wins.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]+\.)+\p{L}{2,}",
    "secret": rf"\b{_SECRET}[\w+/=.~@^-]{{7,}}[\w+/=]",
    "key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "account": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b",
    "card": r"(?<![\d.])(?:\d{4}[ -]){3}\d{4}(?!\d)|(?<![\w.])\d{14,19}(?!\w)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    # Four numbers after "version" or the like are none.
    "ip": rf"(?<![\d.])(?<!(?i:version|release|build|firmware|\bv)[ .:]{{0,2}})(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "phone": r"(?<![\d(+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\d(+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)"
    # National forms: French, German and British after 0, Spanish without it.
    r"|(?<![\w.,(+/-])0[1-9](?:[ .-]?\d{2}){4}(?![\w,/]|[.-]\d)"
    r"|(?<![\w.,(+/-])0\d{2,4}(?:[ /]| ?[/-] ?(?=\d{5}))\d{3,8}(?:[ -]\d{1,5}){0,3}(?![\w,/]|[.-]\d)"
    r"|(?<![\w.,(+/-])020 \d{4} \d{4}(?!\d)|(?<![\w.,(+/-])0\d{9,10}(?![\w,/]|[.-]\d)"
    r"|(?<!\d)\(0\d{1,4}\) ?\d{3,8}(?:[ -]\d{2,5}){0,3}(?!\d)"
    r"|(?<![\w.,(+/-]|\d )(?:[6-9]\d{2}(?: \d{3}){2}|[6-9]\d{2}(?:-\d{3}){2}|[6-9]\d{2}(?:[ -]\d{2}){3}|[89]\d[ -]\d{3}(?:[ -]\d{2}){2})"
    r"(?![\w,/]|[ .-]\d)",
    "person": rf"(?<!\p{{L}}){_TITLED}{_RUN}",
}

#: Where a match of a type can begin; tested before its pattern, which is slow to fail.
_BEGINS = {"secret": "AaPpSsTt", "key": "A", "account": "A-Z", "person": _INITIALS} | dict.fromkeys(("card", "ssn", "ip", "phone"), r"\d+(")
#: Without one of these a text holds no match of any type.
_GATE = (
    r"[0-9@]|A[KS]IA[A-Z]|[=:]\s{0,3}[\x22']?[\w+/=.~@^-]{8}"
    rf"|(?=[{_INITIALS}])(?:{_ANY_TITLE})[.\s]"
)
#: Divides a text into what is no match and what is; a text that holds it is divided in two steps.
_MARK = "\uffff"

#: Given names that tell the gender where the title does not.
_KNOWN = {
    "m": "James John Robert Michael William David Richard Joseph Thomas Charles Peter Hans Klaus Jürgen Wolfgang Jean Pierre "
    "Michel André François Juan José Carlos Antonio Luis Manuel Francisco Иван Александр Дмитрий Алексей Андрей Γιώργος Δημήτρης",
    "f": "Mary Maria María Marie Patricia Jennifer Linda Elizabeth Barbara Susan Sarah Sophie Claire Isabelle Carmen Ana Lucía "
    "Ursula Petra Sabine Monika Éloise Jane Emma Мария Екатерина Татьяна Наталья Анастасия Κατερίνα Ιωάννα",
}
#: Given names by gender and script.
_GIVEN = {
    "m.latin": "Adam Bruno Carl Daniel Emil Felix Georg Hugo Ivan Jakob Karim Leo Martin Nils Oscar Paul",
    "f.latin": "Anna Berta Clara Diana Elena Flora Greta Hanna Irma Julia Karla Laura Marta Nora Olga Paula",
    "n.latin": "Alex Ariel Camille Charlie Chris Dominique Jo Kai Kim Luca Noa Robin Sam Sascha Toni Yael",
    "n.cyrillic": "Саша Женя Валя Слава Шура Паша",
    "m.cyrillic": "Антон Борис Виктор Глеб Денис Егор Захар Игорь Кирилл Лев Максим Никита Олег Павел Роман Сергей",
    "f.cyrillic": "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Лидия Мария Нина Ольга Полина Раиса София Татьяна",
    "m.greek": "Αλέξης Βασίλης Γιάννης Δήμος Ηλίας Θωμάς Ιάσων Κώστας Λουκάς Μάρκος Νίκος Ορέστης Πέτρος Στέφανος Τάσος Φώτης",
    "f.greek": "Άννα Βάσω Γεωργία Δήμητρα Ελένη Ζωή Ηρώ Θάλεια Ιωάννα Κατερίνα Λένα Μαρία Νίκη Όλγα Σοφία Χαρά",
}
_SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa so",
    "cyrillic": "ба бе би бо да де ди до ва ве ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са со",
    "greek": "βα βε βι βο δα δε δι δο φα φε κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σο",
}
_LOWER = {
    "latin": "abcdefghijklmnopqrstuvwxyz", "accented": "àâäçèéêëîïñôöùûü",
    "cyrillic": "абвгдежзиклмнопрстуфхцчшщыэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}


def _q(text: str) -> str:
    return "r'" + text.replace("'", "\\x27") + "'" if "\\" in text or "'" in text else f"'{text}'"


def combined() -> str:
    """All patterns in order; those that begin alike stand together behind one test of the first letter."""
    parts: list[tuple[str | None, list[str]]] = []
    for name, pattern in PATTERNS.items():
        begins = _BEGINS.get(name)
        if not parts or parts[-1][0] != begins:
            parts.append((begins, []))
        parts[-1][1].append(f"(?:{pattern})")
    return "|".join((f"(?=[{b}])(?:{'|'.join(p)})" if b else "|".join(p)) for b, p in parts)


def kind(m: str) -> str:
    """SQL for the type of a match."""
    tests = {name: f"{m} rlike {_q('^(?:' + p + ')$')}" for name, p in PATTERNS.items()}
    return "case " + " ".join(f"when {t} then '{n}'" for n, t in tests.items()) + " end"


def _script(x: str) -> str:
    return f"case when {x} rlike '\\\\p{{IsCyrillic}}' then 'cyrillic' when {x} rlike '\\\\p{{IsGreek}}' then 'greek' else 'latin' end"


def _cased(w: str) -> str:
    """SQL: the norm of a word of a name, alike for SMITH and Smith."""
    return f"if({w} rlike '^\\\\p{{Lu}}{{2,}}$', initcap({w}), {w})"


def _names_of(gender: str) -> str:
    return " ".join(names for k, names in _GIVEN.items() if k.startswith(gender))


def _luhn(digits: str) -> str:
    """SQL: whether the last of the digits is the check digit of the others."""
    return (
        f"aggregate(transform(split(reverse({digits}), ''), (c, i) -> if(i % 2 = 1, 2 * int(c) - if(int(c) > 4, 9, 0), int(c))), "
        "0, (x, y) -> x + y) % 10 = 0"
    )


def entities(m: str) -> str:
    """SQL for the entities of a match: array of (type, prefix, shown, norm); a name is one per word."""
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    head = f"regexp_extract({m}, {_q('^' + _SECRET)}, 0)"
    value = f"substr({m}, length({head}) + 1)"
    title = f"regexp_extract({m}, {_q('^' + _TITLED + '(?=' + _RUN + '$)')}, 0)"
    run = f"substr({m}, length({title}) + 1)"
    parts = f"regexp_extract_all({run}, {_q(_PART)}, 0)"
    # The words after the last space are the surname.
    last = f"size(regexp_extract_all(regexp_extract({run}, '[^ ]+$', 0), {_q(_PART)}, 0))"
    titled = {g: _q(r"(?:^|[\s.])(?:" + _TITLES[g] + r")[.\s]") for g in "fm"}
    # A gender that the title leaves open is that of a given name we know, or stays open.
    given = f"regexp_extract({run}, {_q(_WORD)}, 0)"
    known = {g: f"array_contains(split('{_KNOWN[g]} {_names_of(g)}', ' '), {given})" for g in "fm"}
    gender = (
        f"case when {title} rlike {titled['f']} then 'f' when {title} rlike {titled['m']} then 'm' "
        f"when {known['f']} then 'f' when {known['m']} then 'm' else 'n' end"
    )

    def one(kind_: str, prefix: str, shown: str, norm: str) -> str:
        return f"named_struct('type', {kind_}, 'prefix', {prefix}, 'shown', {shown}, 'norm', {norm})"

    word = f"regexp_extract(x, {_q('(?:' + _WORD + '|(?<=-)' + r'\p{Ll}[\p{L}\p{M}]+' + r'|\p{Lu})$')}, 0)"
    role = f"concat(if(i >= size(p.parts) - p.last, 'surname', p.gender), '.', {_script('w')})"
    before = "concat(if(i = 0, p.title, ''), substr(x, 1, length(x) - length(w)))"
    named = one(role, before, "w", _cased("w"))
    person = f"""element_at(transform(array(named_struct('parts', {parts}, 'last', {last}, 'title', {title}, 'gender', {gender})),
        p -> transform(p.parts, (x, i) -> element_at(transform(array({word}), w -> {named}), 1))), 1)"""
    return f"""case {kind(m)}
      when 'email' then array({one("'email'", "''", m, f'lower({m})')})
      when 'secret' then array({one("'secret'", head, value, value)})
      when 'key' then array({one("'key'", "''", m, m)})
      when 'account' then array({one("'account'", "''", m, f"replace({m}, ' ', '')")})
      when 'card' then array(if({_luhn(digits)}, {one("'card'", "''", m, digits)}, {one("'plain'", m, "''", "''")}))
      when 'ssn' then array({one("'ssn'", "''", m, digits)})
      when 'ip' then array({one("'ip'", "''", m, m)})
      when 'phone' then array({one("'phone'", f"regexp_extract({m}, '^[+][0-9]{{1,3}}(?=[^0-9])', 0)",
        f"regexp_replace({m}, '^[+][0-9]{{1,3}}(?=[^0-9])', '')",
        f"regexp_replace(regexp_replace({m}, '^[+][0-9]{{1,3}}(?=[^0-9])', ''), '[^0-9]', '')")})
      else {person} end"""


def _draw(stream: str, i: str) -> str:
    return f"cast(conv(substr({stream}, 3 * ({i}) + 1, 3), 16, 10) as int)"


def _pick(letters: str, draw: str) -> str:
    return f"substr('{letters}', 1 + {draw} % {len(letters)}, 1)"


def surrogate(kind_: str, norm: str, attempt: str, key: str) -> str:
    """SQL for the surrogate's normal form."""
    stream = (
        f"array_join(transform(sequence(0, length({norm}) div 20 + 1), "
        f"k -> sha2(concat_ws(':', {_q(key)}, {kind_}, {attempt}, k, {norm}), 256)), '')"
    )

    def chars(x: str, hexed: str = "false") -> str:
        draw = _draw("s", "i")
        letter = (
            f"case when c rlike '[0-9]' then cast({draw} % 10 as string) "
            f"when {hexed} and c rlike '[a-f]' then {_pick('abcdef', draw)} "
            f"when c rlike '[A-Za-z]' then {_pick(_LOWER['latin'], draw)} "
            f"when c rlike '\\\\p{{IsLatin}}' then {_pick(_LOWER['accented'], draw)} "
            f"when c rlike '\\\\p{{IsCyrillic}}' then {_pick(_LOWER['cyrillic'], draw)} "
            f"when c rlike '\\\\p{{IsGreek}}' then {_pick(_LOWER['greek'], draw)} else c end"
        )
        cased = f"if(c rlike '\\\\p{{Lu}}', upper({letter}), {letter})"
        return f"array_join(transform(split({x}, ''), (c, i) -> {cased}), '')"

    def with_stream(body: str) -> str:
        return f"element_at(transform(array({stream}), s -> {body}), 1)"

    leading = f"concat(cast(2 + {_draw('s', '40')} % 8 as string), substr({chars(norm)}, 2))"
    body = f"concat(substr({norm}, 1, 1), substr({chars(norm)}, 2, length({norm}) - 2))"
    luhn = (
        "aggregate(transform(split(reverse(b), ''), (c, i) -> if(i % 2 = 0, "
        "2 * int(c) - if(int(c) > 4, 9, 0), int(c))), 0, (x, y) -> x + y)"
    )
    card = f"element_at(transform(array({body}), b -> concat(b, cast((10 - {luhn} % 10) % 10 as string))), 1)"
    octets = "concat_ws('.', " + ", ".join(f"cast(1 + {_draw('s', str(j))} % 254 as string)" for j in range(4)) + ")"
    tld = f"regexp_extract({norm}, '[.][^.]+$', 0)"

    def syllables(script: str, extra: str) -> str:
        listed = "split('" + _SYLLABLES[script] + "', ' ')"
        return f"array_join(transform(sequence(0, 3 + {attempt} {extra}), i -> {listed}[{_draw('s', 'i')} % 32]), '')"

    given = " ".join(
        f"when '{k}' then "
        + with_stream(
            f"concat(split('{names}', ' ')[{_draw('s', '30')} % {len(names.split())}], "
            f"if({attempt} = 0, '', {syllables(k.partition('.')[2], '- 3')}))"
        )
        for k, names in _GIVEN.items()
    )
    made_up = [f"surname.{s}" for s in _SYLLABLES] + [f"{g}.{s}" for g in "fmn" for s in _SYLLABLES if f"{g}.{s}" not in _GIVEN]
    surname = " ".join(f"when '{k}' then " + with_stream(f"initcap({syllables(k.partition('.')[2], '')})") for k in made_up)
    hexed = f"{norm} rlike '^[0-9a-f]+$'"
    return f"""case {kind_}
      when 'email' then {with_stream(f"concat({chars(f'substr({norm}, 1, length({norm}) - length({tld}))')}, {tld})")}
      when 'secret' then {with_stream(chars(norm, hexed))}
      when 'key' then {with_stream(f"concat(substr({norm}, 1, 4), substr({chars(norm)}, 5))")}
      when 'account' then {with_stream(f"concat(substr({norm}, 1, 2), substr({chars(norm)}, 3))")}
      when 'card' then {with_stream(card)}
      when 'ssn' then {with_stream(leading)}
      when 'phone' then {with_stream(f"if({norm} like '0%', concat('0', substr({leading}, 1, 1), substr({chars(norm)}, 3)), {leading})")}
      when 'ip' then {with_stream(octets)}
      {given} {surname} end"""


def _like(w: str, made: str) -> str:
    """SQL: a made name, in capitals where the word it replaces is, an initial for an initial."""
    return f"case when length({w}) = 1 then substr({made}, 1, 1) when {w} rlike '^\\\\p{{Lu}}+$' then upper({made}) else {made} end"


def shown(e: str, made: str) -> str:
    """SQL: a surrogate in the format of the place it is put."""
    digit = f"length(regexp_replace(substr({e}.shown, i + 1), '[^0-9]', ''))"
    poured = (
        f"array_join(transform(split({e}.shown, ''), (c, i) -> "
        f"if(c rlike '[0-9]', substr({made}, length({made}) - {digit} + 1, 1), c)), '')"
    )
    cased = (
        f"array_join(transform(split({e}.shown, ''), (c, i) -> "
        f"if(c rlike '\\\\p{{Lu}}', upper(substr({made}, i + 1, 1)), substr({made}, i + 1, 1))), '')"
    )
    spaced = (
        f"array_join(transform(split({e}.shown, ''), (c, i) -> if(c = ' ', ' ', "
        f"substr({made}, length(replace(substr({e}.shown, 1, i), ' ', '')) + 1, 1))), '')"
    )
    return f"""concat({e}.prefix, case when {e}.type = 'plain' then '' when {e}.type in ('card', 'ssn', 'phone') then {poured}
      when {e}.type = 'email' then {cased} when {e}.type = 'account' then {spaced}
      when {e}.type like '%.%' then {_like(f'{e}.shown', made)} else {made} end)"""


def found(docs: DataFrame) -> DataFrame:
    """doc_id, text, what is no match (``pieces``, one more), and per match its entities.

    The patterns are tried once, and on no text without what every match needs.  A
    match that turns out to be none has a single entity of type ``plain``.
    """
    chosen = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text"))
    every = _q(combined())
    two_steps = (
        f"filter(flatten(zip_with(split(text, {every}, -1), regexp_extract_all(text, {every}, 0), "
        "(a, b) -> array(a, b))), x -> x is not null)"
    )
    parts = f"""case when text is null then null when not (text rlike {_q(_GATE)}) then array(text)
        when instr(text, '{_MARK}') > 0 then {two_steps}
        else split(regexp_replace(text, {every}, '{_MARK}$0{_MARK}'), '{_MARK}', -1) end"""
    return (
        chosen.withColumn("parts", F.expr(parts))
        .withColumn("pieces", F.expr("filter(parts, (x, i) -> i % 2 = 0)"))
        .withColumn("matches", F.expr(f"transform(filter(parts, (x, i) -> i % 2 = 1), m -> {entities('m')})"))
        .drop("parts")
    )


def collisions(docs: DataFrame, key: str) -> DataFrame:
    """type, norm and attempt of every entity whose first surrogate is taken; mostly none.

    The driver runs one round per attempt and sees a count.
    """
    whole = stored(
        found(docs)
        .select(F.explode(F.flatten("matches")).alias("e"))
        .where("e.type != 'plain'")
        .select("e.type", "e.norm")
        .distinct(),
        "entities",
    )
    made = F.expr(surrogate("type", "norm", "attempt", key))
    drawn = whole.withColumn("attempt", F.lit(0))
    for _ in range(MAX_ATTEMPTS):
        drawn = drawn.withColumn("made", made)
        owner = drawn.groupBy("type", "made").agg(F.min("norm").alias("owner"), F.count("*").alias("n"))
        real = whole.select("type", F.col("norm").alias("made"), F.lit(True).alias("real"))
        checked = stored(
            drawn.join(owner, ["type", "made"]).join(real, ["type", "made"], "left")
            .withColumn("taken", F.col("real").isNotNull() | ((F.col("n") > 1) & (F.col("norm") != F.col("owner"))))
            .select("type", "norm", "attempt", "taken"),
            "surrogates",
        )
        if not checked.where("taken").head(1):
            return checked.where("attempt > 0").select("type", "norm", "attempt")
        drawn = checked.select("type", "norm", (F.col("attempt") + F.col("taken").cast("int")).alias("attempt"))
    raise ValueError("a type of entity has fewer surrogates than entities")


def replace(docs: DataFrame, key: str = "newsmart") -> DataFrame:
    """doc_id, text with surrogates, n_entities, and the types met (sorted)."""
    again = stored(collisions(docs, key), "surrogates-again")
    rows = found(docs)
    flat = F.flatten("matches")
    if again.head(1):
        which = (
            rows.select(F.xxhash64("text").alias("h"), "text", F.explode(flat).alias("e"))
            .select("h", "text", "e.type", "e.norm")
            .join(again, ["type", "norm"])
            .groupBy("h", "text")
            .agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws(":", "type", "norm"), "attempt"))).alias("again"))
        )
        rows = rows.join(which, "text", "left").drop("h")
        attempt = "coalesce(element_at(again, concat_ws(':', e.type, e.norm)), 0)"
    else:
        attempt = "0"
    made = surrogate("e.type", "e.norm", attempt, key)
    new = (
        "transform(matches, m -> array_join(transform(m, e -> "
        f"element_at(transform(array({made}), x -> {shown('e', 'x')}), 1)), ''))"
    )
    # Names of the document by norm; an initial names nobody elsewhere.
    own = "array_distinct(filter(flatten(matches), e -> e.type like '%.%' and length(e.norm) > 1).norm)"
    first = "element_at(filter(flatten(matches), e -> e.type like '%.%' and e.norm = n), 1)"
    known = (
        f"element_at(transform(array({own}), ns -> map_from_arrays(ns, transform(ns, n -> "
        f"element_at(transform(array({first}), e -> {made}), 1)))), 1)"
    )
    mention = (
        f"transform(regexp_extract_all(piece, {_q(_MENTION)}, 0), w -> "
        f"element_at(transform(array(known[{_cased('w')}]), y -> if(y is null, w, {_like('w', 'y')})), 1))"
    )
    later = (
        f"if(cardinality(known) = 0, piece, array_join(zip_with(split(piece, {_q(_MENTION)}, -1), {mention}, "
        "(a, b) -> concat(a, coalesce(b, ''))), ''))"
    )
    return rows.select(
        "doc_id",
        F.expr(
            f"""if(size(matches) > 0, element_at(transform(array({known}), known ->
            array_join(zip_with(pieces, {new},
            (piece, x) -> concat({later}, coalesce(x, ''))), '')), 1), text)"""
        ).alias("text"),
        F.greatest(F.size(F.filter("matches", lambda m: m[0]["type"] != "plain")), F.lit(0)).alias("n_entities"),
        F.array_sort(
            F.array_remove(F.array_distinct(F.transform(F.coalesce(flat, F.array()), lambda e: e["type"])), "plain")
        ).alias("types"),
    )
