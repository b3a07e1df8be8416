"""SQL for DuckDB that gives the rows of the registered queries where SQL can express them."""

from __future__ import annotations

from tidelane.llm import mixing, quality_rules, secret_scan, sharding


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spans(kind: int, pattern: str, least: int, value: str = "length(m)") -> str:
    """List of (start, kind, end) of a pattern's matches with a least length."""
    return f"""
    list_filter(list_transform(range(1, len(h{kind}) + 1), lambda i: CASE WHEN {value.replace("(m", f"(h{kind}[i]")} >= {least} THEN
        {{'s': list_sum(list_transform(list_slice(p{kind}, 1, i), lambda x: length(x)))::BIGINT
             + coalesce(list_sum(list_transform(list_slice(h{kind}, 1, i - 1), lambda x: length(x))), 0)::BIGINT,
          'k': {kind}, 'n': length(h{kind}[i])}} END), lambda x: x IS NOT NULL)"""


def secrets_sql(select: str = "*") -> str:
    classes = secret_scan.CLASSES
    patterns = [secret_scan.ASSIGN, secret_scan.ACCESS, secret_scan.HEX, *(c.pattern for c in classes)]
    least = [secret_scan.ASSIGN_LENGTH, secret_scan.ACCESS_LENGTH, secret_scan.HEX_LENGTH]
    names = [*secret_scan.BASE_KINDS, *(c.kind for c in classes)]
    allowed = _quoted("|".join(secret_scan.ALLOWED))
    cut = ", ".join(
        f"string_split_regex(t, {_quoted(p)}) AS p{i}, regexp_extract_all(t, {_quoted(p)}) AS h{i}"
        for i, p in enumerate(patterns)
    )
    base = ", ".join(
        _spans(i, p, least[i], f"length(regexp_extract(m, {_quoted(secret_scan.ASSIGN)}, 2))" if i == 0 else "length(m)")
        for i, p in enumerate(patterns[:3])
    )
    added = []
    for i, c in enumerate(classes, 3):
        table = "[" + ", ".join(map(str, c.table)) + "]"
        high = f"""list_filter(range(0, length(h) - {c.window - 1}), lambda j: list_sum(list_transform(
            map_values(list_histogram(string_split(substr(h, j + 1, {c.window}), ''))),
            lambda n: ({table})[(n + 1)::BIGINT])) <= {c.most})"""
        added.append(f"""
        list_filter(list_transform(list_zip({_spans(i, patterns[i], 0)}, h{i}), lambda z: CASE WHEN NOT regexp_matches(z[2], {allowed}) THEN
            {{'s': z[1].s, 'h': z[2], 'w': {high.replace("(h,", "(z[2],").replace("length(h)", "length(z[2])")}, 'k': {i}, 'c': {c.window}}} END),
            lambda x: x IS NOT NULL AND len(x.w) > 0)""")
    said = "[" + ", ".join(map(_quoted, names)) + "]"
    join = lambda x: (
        f"coalesce(list_aggregate(list_transform(list_sort({x}), lambda s: ({said})[s.k + 1] || ':' || s.s || ':' || s.e), 'string_agg', ','), '')"
    )
    return f"""
    WITH texts AS (SELECT * EXCLUDE (text), text, coalesce(text, '') AS t FROM documents),
    cut AS (SELECT *, {cut} FROM texts),
    found AS (SELECT *, list_transform(flatten([{base}]), lambda x: {{'s': x.s, 'k': x.k, 'e': x.s + x.n}}) AS b,
        flatten([{", ".join(
            f"list_transform({a}, lambda x: {{'s': x.s + x.w[1], 'k': x.k, 'e': x.s + x.w[len(x.w)] + x.c}})" for a in added
        )}]) AS a FROM cut),
    scanned AS (SELECT * EXCLUDE (t, b, a), len(list_filter(b, lambda x: x.k = 0)) AS n_assign, len(list_filter(b, lambda x: x.k = 1)) AS n_access,
        len(list_filter(b, lambda x: x.k = 2)) AS n_hex, {join("b")} AS base_spans, {join("list_concat(b, a)")} AS spans FROM found)
    SELECT {select} FROM scanned"""


def quality_rules_sql() -> str:
    rates = quality_rules.RATES
    rate = {r.name: f"CASE WHEN n_words > 0 THEN (1000 * {r.numerator}) // ({r.denominator}) END" for r in rates}
    bucket = "CASE WHEN v < 32 THEN v ELSE (length(bin(v)) - 6) * 32 + (v >> (length(bin(v)) - 6)::BIGINT) END"
    top = lambda q: f"CASE WHEN {q} < 64 THEN {q} ELSE (({q} - ({q} // 32 - 1) * 32 + 1) << ({q} // 32 - 1)::BIGINT) - 1 END"
    high = lambda r: f"max(q3 + 3 * greatest(q3 - q1, {r.floor})) FILTER (rate = '{r.name}') AS {r.name}_high"
    low = lambda r: f"max(greatest(q1 - 3 * greatest(q3 - q1, {r.floor}), 0)) FILTER (rate = '{r.name}') AS {r.name}_low"
    names = [f"{r.name}_high" for r in rates] + [f"{r.name}_low" for r in rates if r.both_sides]
    drawn = lambda side, n, above: f"(({side}.documents::HUGEINT * {side}.{n} + 200 * ({above})) // ({side}.documents::HUGEINT + 200))"
    pick = ", ".join(f"{drawn('o', n, drawn('u', n, f't.{n}'))}::BIGINT AS {n}" for n in names)
    inside = " AND ".join(
        f"({rate[r.name]}) <= {r.name}_high" + (f" AND ({rate[r.name]}) >= {r.name}_low" if r.both_sides else "") for r in rates
    )
    return f"""
    WITH numbered AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
    words AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (
        SELECT rid, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM numbered)),
    windows AS (SELECT rid, i, w || ' ' || lead(w) OVER p || ' ' || lead(w, 2) OVER p AS g FROM words WINDOW p AS (PARTITION BY rid ORDER BY i)),
    twice AS (SELECT rid, i FROM windows WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
    repeats AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
    line AS (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM numbered),
    lines AS (SELECT rid, count(*) AS n, count(DISTINCT l) AS d FROM line WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
    measured AS (SELECT a.rid, doc_id, lang, source, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_words,
        length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        coalesce(l.n, 0)::BIGINT AS n_lines, coalesce(l.n - l.d, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
        FROM numbered a LEFT JOIN lines l USING (rid) LEFT JOIN repeats r USING (rid)),
    rated AS ({" UNION ALL ".join(f"SELECT lang, source, '{r.name}' AS rate, ({rate[r.name]})::BIGINT AS v FROM measured WHERE n_words > 0" for r in rates)}),
    leveled AS (SELECT 0 AS level, lang, source, rate, v FROM rated UNION ALL SELECT 1, lang, NULL, rate, v FROM rated
        UNION ALL SELECT 2, NULL, NULL, rate, v FROM rated),
    sketch AS (SELECT level, lang, source, rate, {bucket} AS b, count(*) AS n FROM leveled GROUP BY ALL),
    climbed AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY b) AS upto,
        sum(n) OVER (PARTITION BY level, lang, source, rate) AS total FROM sketch),
    quartile AS (SELECT level, lang, source, rate, max(total) AS documents, min(b) FILTER (upto * 4 >= total)::BIGINT AS b1,
        min(b) FILTER (upto * 4 >= total * 3)::BIGINT AS b3 FROM climbed GROUP BY ALL),
    quartiles AS (SELECT *, {top("b1")} AS q1, {top("b3")} AS q3 FROM quartile),
    wide AS (SELECT level, lang, source, max(documents) AS documents, {", ".join([high(r) for r in rates] + [low(r) for r in rates if r.both_sides])}
        FROM quartiles GROUP BY level, lang, source),
    bounds AS (SELECT o.lang, o.source, {pick} FROM wide o LEFT JOIN wide u ON u.level = 1 AND u.lang IS NOT DISTINCT FROM o.lang
        LEFT JOIN wide t ON t.level = 2 WHERE o.level = 0),
    judged AS (SELECT m.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, coalesce({inside}, false) AS inside
        FROM measured m LEFT JOIN bounds b ON m.lang IS NOT DISTINCT FROM b.lang AND m.source IS NOT DISTINCT FROM b.source)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND inside AS kept FROM judged"""


def sharding_sql(shards: int = 16) -> str:
    first, second = sharding.MULTIPLIERS
    low = sharding.LOW
    levels = ["SELECT rid, n, half, x >> half AS l0, x & ((1::BIGINT << half) - 1) AS r0 FROM walk"]
    keys = sharding.Permutation.keys
    for i, key in enumerate(keys):
        f = f"((r{i} * {first} + {key}) & {low})"
        g = f"((xor({f}, {f} >> 15) * {second}) & {low})"
        levels.append(
            f"SELECT rid, n, half, r{i} AS l{i + 1}, xor(l{i}, xor({g}, {g} >> 13) & ((1::BIGINT << half) - 1)) AS r{i + 1} FROM ({levels[-1]})"
        )
    k = len(keys)
    steps = "list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)"
    return f"""
    WITH RECURSIVE crc AS (SELECT list({steps} ORDER BY n) AS tab FROM (SELECT unnest(range(256)) AS n)),
    texts AS (SELECT DISTINCT coalesce(text, '') AS t FROM documents),
    digests AS (SELECT t, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(regexp_replace(lower(hex(encode(t))), '(..)', '\\1,', 'g'), ',')[:-2],
            lambda h: (16 * (strpos('0123456789abcdef', h[1]) - 1) + strpos('0123456789abcdef', h[2]) - 1)::BIGINT)),
        lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1]))) AS crc FROM texts, crc),
    sized AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, crc::BIGINT AS text_crc32
        FROM documents JOIN digests ON t = coalesce(text, '')),
    numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS rid, count(*) OVER () AS n FROM sized),
    walk AS (SELECT rid, n, greatest(1, (length(bin(greatest(n, 2) - 1)) + 1) // 2)::BIGINT AS half, rid::BIGINT AS x, 0 AS step FROM numbered
        UNION ALL
        SELECT rid, n, half, (l{k} << half) | r{k} AS x, 1 AS step FROM ({levels[-1].replace("FROM walk", "FROM walk WHERE step = 0 OR x >= n")}))
    SELECT doc_id, size, text_crc32, 'rows' AS law, (x % {shards})::INT AS shard, x // {shards} AS slot, NULL::INT AS grown_shard
    FROM numbered JOIN walk USING (rid) WHERE step = 1 AND x < walk.n"""


def mixing_ctes(documents: str = "documents") -> str:
    """Targets by filling sources in order, and words taken as whole laps and a rest of each stream."""
    seed = mixing.Settings().seed
    return f"""
    sized AS (SELECT * EXCLUDE (source), source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
        md5('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS mix_key FROM {documents}),
    sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighed AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::BIGINT AS weight FROM sources),
    climbed AS (SELECT *, sum(source_size) OVER () AS total, coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mosts,
        sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM weighed
        WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
    marked AS (SELECT *, 3 * source_size::HUGEINT * weights <= weight * (total - mosts) AS is_full FROM climbed),
    rest AS (SELECT max(total) - coalesce(sum(3 * source_size) FILTER (is_full), 0) AS words, sum(weight) FILTER (NOT is_full) AS weight FROM marked),
    targets AS (SELECT source, source_size, CASE WHEN is_full THEN (3 * source_size)::DOUBLE ELSE (m.weight * words)::DOUBLE / rest.weight::DOUBLE END AS target
        FROM marked m, rest),
    streamed AS (SELECT s.*, source_size, target, floor(target)::BIGINT AS quota,
        sum(size) OVER (PARTITION BY s.source ORDER BY mix_key, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT - size AS begins
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
    mixed AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE quota // source_size * size
        + greatest(0, least(begins + size, quota % source_size) - begins) END::BIGINT AS taken FROM streamed)"""


def mixing_sql() -> str:
    """Slots by reversing the bits of all points, numbered per source in their order, and the documents that they take."""
    wide = 512
    return f"""
    WITH {mixing_ctes()},
    numbered AS (SELECT DISTINCT source, source_size, floor(target)::BIGINT AS quota FROM targets),
    counted AS (SELECT *, (source_size + {wide - 1}) // {wide} AS blocks,
        CASE WHEN source_size > 0 THEN quota // source_size * ((source_size + {wide - 1}) // {wide}) + (quota % source_size + {wide - 1}) // {wide} ELSE 0 END AS slots
        FROM numbered),
    ranged AS (SELECT *, sum(slots) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) - slots AS low, length(bin(greatest(sum(slots) OVER (), 2)::BIGINT - 1)) AS bits
        FROM counted),
    points AS (SELECT source, source_size, quota, blocks, list_reduce(list_prepend(0::BIGINT, list_transform(range(0, bits),
        lambda b: ((p >> b::BIGINT) & 1) << (bits - 1 - b)::BIGINT)), lambda x, y: x + y) AS slot
        FROM ranged, unnest(range(low::BIGINT, (low + slots)::BIGINT)) AS u(p)),
    ranks AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS k FROM points),
    placed AS (SELECT source, slot, (k % blocks) * {wide} AS a, least((k % blocks + 1) * {wide}, source_size, quota - k // blocks * source_size) AS b FROM ranks),
    rows_ AS (SELECT *, row_number() OVER () AS r FROM mixed),
    met AS (SELECT r, min(slot) AS first_slot, count(*) AS n_slots FROM rows_ m JOIN placed p ON m.source IS NOT DISTINCT FROM p.source
        AND p.a < begins + size AND p.b > begins AND size > 0 AND p.b > p.a GROUP BY r)
    SELECT doc_id, size, source_size, target, taken, first_slot::BIGINT AS first_slot, coalesce(n_slots, 0)::BIGINT AS n_slots FROM rows_ LEFT JOIN met USING (r)"""


def collocations_sql() -> str:
    """All n-grams of one to four words, unpacked and counted."""
    grams = "\n    UNION ALL ".join(
        f"SELECT lang, array_to_string(list_slice(w, i, i + {k - 1}), ' ') AS phrase, {k} AS words FROM pieces, unnest(range(1, len(w) - {k - 2})) AS u(i)"
        for k in (1, 2, 3, 4)
    )
    return f"""
    WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
        FROM documents WHERE text IS NOT NULL),
    grams AS ({grams}),
    counted AS (SELECT lang, phrase, words, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
    candidates AS (SELECT lang, phrase, string_split(phrase, ' ') AS w, words, f AS a FROM counted WHERE words > 1),
    cuts AS (SELECT *, unnest(range(1, words)) AS k FROM candidates),
    parts AS (SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a // (l.f::HUGEINT + r.f))::BIGINT AS score
        FROM cuts c JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.w, 1, c.k), ' ')
        JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.w, c.k + 1, c.words), ' ')),
    best AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inner_phrases AS (SELECT lang, a, unnest(flatten(list_transform(range(2, words), lambda m: list_transform(range(1, words - m + 2),
        lambda i: array_to_string(list_slice(w, i, i + m - 1), ' '))))) AS phrase FROM candidates WHERE words > 2),
    covered AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL),
    kept AS (SELECT b.* FROM best b LEFT JOIN covered c USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l,
        r::BIGINT AS r, n, score FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000"""


def conversations_sql() -> str:
    """The programme as a recursion over the turns; a state is (cost, audit, repaired text), compared in this order."""
    steps = "n"
    for _ in range(8):
        steps = f"CASE WHEN {steps} % 2 = 1 THEN xor(3988292384, {steps} // 2) ELSE {steps} // 2 END"
    text = "(conv_key || ':' || turn_key)"

    def move(place: str, cost: str, letter: str, written: str, when: str = "TRUE") -> str:
        return f"CASE WHEN {place} IS NOT NULL AND {when} THEN {{'c': {place}.c + {cost}, 'e': {place}.e || '{letter}', 't': {place}.t || {written}}} END"

    keep = lambda place, initial: move(
        place, "extra", "K", "chr(10) || role || ':' || text", f"NOT faulty AND initial = '{initial}'"
    )
    anew = lambda place, role: move(place, "(3 + extra)", "R", f"chr(10) || '{role}:' || text", "NOT faulty")
    put = lambda place, role: move(place, "3", "I", f"chr(10) || '{role}:'")
    gone = lambda place: move(place, "4", "D", "''")
    least = lambda *options: f"list_min([{', '.join(options)}])"
    before_user = ("p", "s", "a")
    user = least(gone("u"), *[keep(x, "u") for x in before_user], *[anew(x, "user") for x in before_user])
    helper = least(gone("a"), keep("u", "a"), anew("u", "assistant"))
    with_user = least("u", *[put(x, "user") for x in before_user])
    return f"""
    WITH RECURSIVE crc AS (SELECT list({steps} ORDER BY n) AS tab FROM (SELECT unnest(range(256)) AS n)),
    keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') AS conv_key,
        coalesce(turn::VARCHAR, ' ') AS turn_key FROM conversations),
    hit AS (SELECT *, (xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1]))) % 20)::INT AS h FROM keyed, crc),
    turns AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM hit, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) WHERE h <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM turns),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS copy,
        left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM placed),
    faults AS (SELECT *, said = '' AS is_blank, said <> '' AND copy > 1 AS is_copy, said <> '' AND copy = 1 AND right(said, 1) NOT IN ('.', '!', '?') AS is_cut,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM numbered),
    costed AS (SELECT *, is_blank OR is_copy AS faulty, CASE WHEN is_cut THEN 3 ELSE 0 END AS extra FROM faults),
    named AS (SELECT conv_id FROM conversations GROUP BY conv_id),
    raw AS (SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'e': '', 't': ''}} AS p, NULL::STRUCT(c INT, e VARCHAR, t VARCHAR) AS s,
            {{'c': 3, 'e': 'I', 't': chr(10) || 'user:'}} AS u, {{'c': 6, 'e': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS a FROM named
        UNION ALL
        SELECT conv_id, i, p, s, u, {least("a", put("u", "assistant"))} AS a FROM (
            SELECT conv_id, i, p, s, {with_user} AS u, a FROM (
                SELECT r.conv_id, c.i, {gone("p")} AS p, {least(gone("s"), keep("p", "s"))} AS s, {user} AS u, {helper} AS a
                FROM raw r JOIN costed c ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND c.i = r.i + 1))),
    ended AS (SELECT conv_id, list_min([p, a]) AS best FROM raw QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
    counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(is_blank) AS blank, count_if(is_copy) AS duplicate,
        count_if(is_cut) AS truncated, count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM costed GROUP BY conv_id)
    SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
        coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.e AS audit,
        sha256(substr(best.t, 2)) AS repaired_sha256 FROM ended e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""


def oracle_sql() -> dict[str, str]:
    return {
        "op11_phrase_collocations": collocations_sql(),
        "op13_conversation_repair": conversations_sql(),
        "op9_mixing": mixing_sql(),
        "op8_sharding": sharding_sql(),
        "op6_quality_rules": quality_rules_sql(),
        "op3_secret_scan": secrets_sql("doc_id, n_assign, n_access, n_hex, sha256(base_spans) AS base_sha256, spans"),
    }
