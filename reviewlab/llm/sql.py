"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = f"translate(text, '{UPPER}', '{LOWER}')"
WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def cte(*parts: tuple[str, str]) -> str:
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({body})" for name, body in parts) + "\n"


DECONTAMINATE = (
    cte(
        (
            "bench",
            f"SELECT item_id, regexp_extract_all({ASCII_LOWER}, {WORD}) AS w FROM benchmark "
            "WHERE item_id IS NOT NULL",
        ),
        ("sized", "SELECT item_id, w, len(w) AS n, least(len(w), 10) AS m FROM bench WHERE len(w) > 0"),
        (
            "cut",
            "SELECT DISTINCT item_id, m, array_to_string(w[i:i+m-1], ' ') AS win FROM "
            "(SELECT item_id, w, m, unnest(range(1, n - m + 2)) AS i FROM sized)",
        ),
        (
            "docs",
            "SELECT row_number() OVER () AS r, doc_id, "
            f"coalesce(regexp_extract_all({ASCII_LOWER}, {WORD}), []) AS w FROM documents",
        ),
        (
            "runs",
            "SELECT r, m, i, array_to_string(w[i:i+m-1], ' ') AS win FROM "
            "(SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i "
            "FROM docs, (SELECT DISTINCT m FROM cut))",
        ),
        (
            "hits",
            "SELECT r, runs.i, runs.m, item_id FROM runs JOIN cut ON runs.win = cut.win AND runs.m = cut.m",
        ),
        (
            "per_word",
            "SELECT r, count(DISTINCT p) AS n_hit FROM "
            "(SELECT r, unnest(range(i, i + m)) AS p FROM hits) GROUP BY r",
        ),
        (
            "per_item",
            "SELECT r, count(DISTINCT item_id) AS n_items, "
            "sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS h "
            "FROM hits GROUP BY r",
        ),
    )
    + "SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, "
    "CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256, "
    "coalesce(n_hit, 0) > 0 AS contaminated "
    "FROM docs LEFT JOIN per_word USING (r) LEFT JOIN per_item USING (r)"
)

# Pairs that share a shingle are counted in full, so this suits small tables only.
JACCARD_JOIN = (
    cte(
        (
            "docs",
            f"SELECT doc_id, list_filter(string_split_regex({ASCII_LOWER}, '[\\x20\\x09-\\x0D]+'), "
            "lambda x: x <> '') AS w FROM documents",
        ),
        (
            "grams",
            "SELECT DISTINCT doc_id, array_to_string(w[i:i+3], ' ') AS g FROM "
            "(SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM docs WHERE len(w) > 0)",
        ),
        ("sizes", "SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id"),
        (
            "both_sides",
            "SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b "
            "ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL",
        ),
        (
            "links",
            "SELECT x, y FROM both_sides JOIN sizes s ON x = s.doc_id JOIN sizes t ON y = t.doc_id "
            "WHERE 100 * c >= 85 * (s.n + t.n - c)",
        ),
        (
            "reached",
            "SELECT doc_id AS root, doc_id AS node FROM documents UNION "
            "SELECT root, y FROM reached JOIN links ON node = x WHERE y > root",
        ),
        (
            "least",
            "SELECT node, min(root) AS component_id FROM reached GROUP BY node",
        ),
        # a path to the smallest key goes over larger keys only, so it is found from its root
    )
    + "SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, component_id "
    "FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN least ON node = d.doc_id"
)

CHAT_FORMAT = (
    cte(
        (
            "turns",
            "SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations "
            "UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' "
            "UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'",
        ),
        (
            "sized",
            "SELECT *, length(regexp_replace(role, '[\\\\#<:]', 'xx', 'g')) "
            "+ length(regexp_replace(text, '[\\\\#<]', 'xx', 'g')) + 15 AS size FROM turns",
        ),
        (
            "joined",
            "SELECT conv_id, count(*) AS n, "
            "string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS t, "
            "coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') "
            "AS loss, sum(size) AS size FROM sized GROUP BY conv_id",
        ),
    )
    + "SELECT conv_id, n AS n_turns, sha256(t) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, "
    "sha256(loss) AS loss_sha256, CAST(size AS BIGINT) AS formatted_chars FROM joined"
)


def folded_words(text: str) -> str:
    return (
        f"list_filter(string_split_regex(replace(lower(coalesce({text}, '')), 'ς', 'σ'), "
        "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    )


def license_scan(templates: dict[str, str], dice: float) -> str:
    rows = ", ".join(
        "('" + name.replace("'", "''") + "', '" + text.replace("'", "''") + "')"
        for name, text in templates.items()
    )
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return (
        cte(
            ("templates(template, text)", f"VALUES {rows}"),
            ("known_words", f"SELECT template, {folded_words('text')} AS w FROM templates"),
            ("known", f"SELECT template, {pairs} AS k FROM known_words"),
            (
                "lines",
                "SELECT r, doc_id, unnest(l) AS piece, generate_subscripts(l, 1) - 1 AS line FROM "
                "(SELECT row_number() OVER () AS r, doc_id, string_split(text, chr(10)) AS l FROM documents)",
            ),
            ("own_words", f"SELECT r, doc_id, line, {folded_words('piece')} AS w FROM lines"),
            ("own", f"SELECT r, doc_id, line, {pairs} AS o FROM own_words WHERE len(w) > 1"),
            (
                "scored",
                "SELECT r, doc_id, line, template, "
                "2.0::DOUBLE * len(list_intersect(o, k)) / (len(o) + len(k)) AS dice FROM own, known",
            ),
        )
        + f"SELECT doc_id, CAST(line AS BIGINT) AS line, template, dice FROM scored WHERE dice >= {dice}"
    )


def imatch(f) -> str:
    """``f`` is the module of the operator, for its parameters."""

    def hexed(text: str, start: int, digits: int) -> str:
        parts = (
            f"(strpos('0123456789abcdef', substr({text}, {start + d}, 1)) - 1) * {16 ** (digits - 1 - d)}"
            for d in range(digits)
        )
        return "(" + " + ".join(parts) + ")"

    def hashes(level: str) -> str:
        return (
            f"array_to_string(list_transform(range({f.SUBSETS}), lambda r: CASE WHEN "
            f"len(list_filter(own, lambda e: e.subset = r AND e.number % (1 << ({level})) = 0)) = 0 "
            f"THEN '{f.NO_TERM}' ELSE substr(md5(array_to_string(list_sort(list_transform("
            f"list_filter(own, lambda e: e.subset = r AND e.number % (1 << ({level})) = 0), lambda e: e.term)), ' ')), "
            f"1, {f.DIGITS}) END), '')"
        )

    wide = f.SUBSETS * f.DIGITS

    def pick(side: str) -> str:
        return (
            f"substr({side}, (4 + (greatest(la, lb) - {'la' if side == 'a' else 'lb'}) * {wide} "
            f"+ r * {f.DIGITS})::BIGINT, {f.DIGITS})"
        )

    def near(a: str, b: str) -> str:
        same = f"len(list_filter(range({f.SUBSETS}), lambda r: {pick('a')} = {pick('b')} AND {pick('a')} <> '{f.NO_TERM}'))"
        some = f"len(list_filter(range({f.SUBSETS}), lambda r: {pick('a')} <> '{f.NO_TERM}' OR {pick('b')} <> '{f.NO_TERM}'))"
        return (
            "SELECT r0, CASE WHEN a = b THEN 1.0::DOUBLE WHEN abs(la - lb) <= 1 THEN "
            f"coalesce({same}::DOUBLE / nullif({some}, 0), 0.0) ELSE 0.0 END AS near FROM "
            f"(SELECT r0, {a} AS a, {b} AS b, TRY_CAST(substr({a}, 1, 2) AS INTEGER) AS la, "
            f"TRY_CAST(substr({b}, 1, 2) AS INTEGER) AS lb FROM together)"
        )

    return (
        cte(
            (
                "docs",
                "SELECT row_number() OVER (ORDER BY doc_id DESC) AS r0, doc_id, coalesce(text, '') AS text "
                "FROM documents",
            ),
            (
                "following",
                "SELECT *, length(text) AS n, length(text) // 3 AS take, coalesce(lead(text) OVER (ORDER BY r0), "
                "first_value(text) OVER (ORDER BY r0)) AS after FROM docs",
            ),
            (
                "texts",
                "SELECT r0, 'own' AS which, text AS t FROM docs UNION ALL "
                "SELECT r0, 'edited', substr(text, 1, n - take) || substr(after, 1, take) FROM following",
            ),
            (
                "words",
                f"SELECT r0, which, unnest(list_distinct({folded_words('t')})) AS term FROM texts",
            ),
            (
                "band",
                "SELECT term, md5(term) AS h FROM words WHERE which = 'own' GROUP BY term HAVING "
                f"count(*) >= {f.MIN_SHARE} * (SELECT count(*) FROM docs) "
                f"AND count(*) <= {f.MAX_SHARE} * (SELECT count(*) FROM docs)",
            ),
            (
                "entries",
                f"SELECT r0, which, list({{'term': term, 'subset': {hexed('h', 1, 2)} % {f.SUBSETS}, "
                f"'number': {hexed('h', 3, 4)}}}) AS own FROM words JOIN band USING (term) GROUP BY ALL",
            ),
            (
                "levels",
                "SELECT t.r0, t.which, t.t, own, "
                f"len(list_filter(range({f.LEVELS - 1}), lambda i: coalesce(len(own), 0) > ({f.SUBSETS} << i))) AS j "
                "FROM texts t LEFT JOIN entries e ON t.r0 = e.r0 AND t.which = e.which",
            ),
            (
                "prints",
                f"SELECT r0, which, t, CASE WHEN coalesce(len(own), 0) < {f.LEAST_TERMS} THEN 'text:' || sha256(t) "
                f"ELSE lpad(CAST(j AS VARCHAR), 2, '0') || ':' || {hashes('j')} || {hashes('j + 1')} END AS p "
                "FROM levels",
            ),
            (
                "together",
                "SELECT o.r0, o.p AS own, e.p AS edited, sha256(e.t) AS edited_sha256, "
                "coalesce(lead(o.p) OVER (ORDER BY o.r0), first_value(o.p) OVER (ORDER BY o.r0)) AS next "
                "FROM prints o JOIN prints e ON o.r0 = e.r0 AND o.which = 'own' AND e.which = 'edited'",
            ),
            ("near_e", near("own", "edited")),
            ("near_n", near("own", "next")),
        )
        + "SELECT doc_id, CAST(n AS BIGINT) AS n_chars, edited_sha256, own AS fingerprint, "
        "edited AS edited_fingerprint, e.near AS near_edited, x.near AS near_next "
        "FROM following JOIN together USING (r0) JOIN near_e e USING (r0) JOIN near_n x USING (r0)"
    )


def _field(column: str) -> str:
    value = f"CAST({column} AS VARCHAR)"
    return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    columns = ["doc_id", "source", "lang", n_chars, "text"]
    return f"sha256({' || '.join(map(_field, columns))})"


def _tree(leaves: str) -> str:
    """Levels (g, lvl, i, n, h) over leaves (g, i, n, h); n is the size of the level."""
    return (
        f"SELECT g, 0 AS lvl, i, n, h FROM {leaves} UNION ALL "
        "SELECT g, lvl + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) "
        "FROM {} WHERE n > 1 GROUP BY g, lvl, i // 2"
    )


def _fold(start: str, tree: str) -> str:
    """What the nodes (r, g, i, h) of ``start`` become level by level, with their siblings."""
    return (
        f"SELECT r, g, 0 AS lvl, i, h, '' AS s FROM {start} UNION ALL "
        "SELECT f.r, f.g, f.lvl + 1, f.i // 2, CASE WHEN t.h IS NULL THEN sha256(f.h) "
        "WHEN f.i % 2 = 0 THEN sha256(f.h || t.h) ELSE sha256(t.h || f.h) END, f.s || coalesce(t.h, '') "
        f"FROM {{}} f JOIN {tree}_sizes z ON z.g = f.g AND z.lvl = f.lvl AND z.n > 1 "
        f"LEFT JOIN {tree} t ON t.g = f.g AND t.lvl = f.lvl AND t.i = xor(f.i, 1)"
    )


def _ends(fold: str) -> str:
    return f"SELECT r, arg_max(h, lvl) AS h, arg_max(s, lvl) AS s FROM {fold} GROUP BY r"


# Fixed value: the reversed polynomial of CRC-32.
_CRC_BYTE = (
    "list_reduce(range(8), lambda c, k: "
    "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)"
)
MERKLE = (
    cte(
        ("bytes", f"SELECT list({_CRC_BYTE} ORDER BY i) AS t FROM range(256) x(i)"),
        (
            "docs",
            "SELECT *, row_number() OVER () AS r, coalesce('=' || lang, '-') AS g, "
            f"{_leaf('n_chars')} AS leaf, {_leaf('n_chars + 1')} AS other, "
            "xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
            "lambda d: CAST(ascii(d) AS BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), "
            "4294967295), 4294967295) % 7 = 0 AND n_chars IS NOT NULL AS tampered FROM documents, bytes",
        ),
        (
            "leaves",
            "SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, "
            "count(*) OVER (PARTITION BY g) AS n, leaf AS h FROM docs",
        ),
        ("tree", _tree("leaves").format("tree")),
        ("tree_sizes", "SELECT g, lvl, any_value(n) AS n FROM tree GROUP BY g, lvl"),
        ("subroots", "SELECT g, h FROM tree WHERE n = 1"),
        (
            "tops",
            "SELECT '' AS g, g AS grp, row_number() OVER (ORDER BY g) - 1 AS i, "
            "count(*) OVER () AS n, h FROM subroots",
        ),
        ("crown", _tree("tops").format("crown")),
        ("crown_sizes", "SELECT g, lvl, any_value(n) AS n FROM crown GROUP BY g, lvl"),
        ("root", "SELECT h FROM crown WHERE n = 1"),
        ("proof", _fold("leaves", "tree").format("proof")),
        ("proofs", _ends("proof")),
        ("crown_start", "SELECT grp AS r, g, i, h FROM tops"),
        ("crown_proof", _fold("crown_start", "crown").format("crown_proof")),
        ("crown_proofs", _ends("crown_proof")),
        (
            "forged",
            "SELECT r, g, i, CASE WHEN tampered THEN other ELSE leaf END AS h FROM leaves",
        ),
        ("forged_fold", _fold("forged", "tree").format("forged_fold")),
        ("forged_ends", _ends("forged_fold")),
        (
            "forged_tops",
            "SELECT f.r, t.g, t.i, f.h FROM forged_ends f JOIN leaves l USING (r) JOIN tops t ON t.grp = l.g",
        ),
        ("forged_crown", _fold("forged_tops", "crown").format("forged_crown")),
        ("folded", _ends("forged_crown")),
    )
    + "SELECT l.doc_id, l.leaf, s.h AS subroot, root.h AS root, sha256(p.s || c.s) AS proof_sha256, "
    "folded.h AS folded_root, folded.h = root.h AS verified FROM leaves l JOIN subroots s ON s.g = l.g "
    "JOIN proofs p ON p.r = l.r JOIN crown_proofs c ON c.r = l.g JOIN folded ON folded.r = l.r, root"
)


def vector_codes(parts: int, entries: int, rounds: int) -> str:
    """Lloyd's rounds one after the other; whole numbers as doubles, which hold them exactly."""
    found = [
        (
            "vectors",
            "SELECT row_number() OVER () AS r, vec_id, label, "
            "list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v FROM embeddings "
            "WHERE embedding IS NOT NULL AND len(list_filter(embedding, "
            "lambda x: x IS NULL OR NOT isfinite(x))) = 0",
        ),
        (
            "parts",
            f"SELECT r, vec_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x "
            f"FROM vectors, range({parts}) t(p)",
        ),
        (
            "book_0",
            "SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts "
            f"WHERE vec_id IN (SELECT vec_id FROM vectors ORDER BY vec_id LIMIT {entries})",
        ),
    ]
    for k in range(rounds + 1):
        found.append(
            (
                f"near_{k}",
                "SELECT r, p, any_value(x) AS x, min(CAST(list_inner_product(x, x) "
                "- 2 * list_inner_product(x, c) + list_inner_product(c, c) AS BIGINT) * 65536 + e) AS m "
                f"FROM parts JOIN book_{k} USING (p) GROUP BY r, p",
            )
        )
        if k < rounds:
            found += [
                (
                    f"means_{k}",
                    "SELECT p, e, list(c ORDER BY i) AS c FROM (SELECT p, m % 65536 AS e, i, "
                    "floor(sum(x[i]) / count(*)) AS c FROM (SELECT p, m, x, "
                    f"unnest(range(1, len(x) + 1)) AS i FROM near_{k}) GROUP BY ALL) GROUP BY p, e",
                ),
                (
                    f"book_{k + 1}",
                    f"SELECT p, e, coalesce(n.c, o.c) AS c FROM book_{k} o LEFT JOIN means_{k} n USING (p, e)",
                ),
            ]
    return (
        cte(
            *found,
            (
                "codes",
                "SELECT r, string_agg(printf('%02x', m % 65536), '' ORDER BY p) AS code, "
                f"CAST(sum(m // 65536) AS BIGINT) AS error FROM near_{rounds} GROUP BY r",
            ),
            (
                "hash",
                "SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), "
                f"','), ',' ORDER BY p, e)) AS h FROM book_{rounds}",
            ),
        )
        + "SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, "
        "h AS codebooks_sha256 FROM codes JOIN vectors USING (r), hash"
    )
