"""The queries of this package in SQL of an independent engine, where SQL expresses them."""

from __future__ import annotations

#: A byte's checksum step: eight shifts, each with the reversed polynomial of CRC-32 where a bit falls out.
_SHIFTS = "list_reduce(list_prepend({start}, [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
_LEVELS = 6  # of sixteen-fold nodes: enough for 16 million rows


def checksums(source: str, text: str, name: str = "crc") -> str:
    """A table expression: the rows of ``source`` with the unsigned CRC-32 of the UTF-8 text ``text``, over distinct texts only."""
    step = "xor(c >> 8, t.list[1 + xor(c & 255, b)])"
    bytes_ = "list_transform(range(1, 2 * octet_length(encode(txt)), 2), lambda k: (('0x' || substring(h, k, 2))::BIGINT))"
    return f"""
      crc_table AS (SELECT list(c ORDER BY i) AS list FROM (SELECT i, {_SHIFTS.format(start="i")} AS c FROM range(256) r(i))),
      {name}_texts AS (SELECT txt, hex(encode(txt)) AS h FROM (SELECT DISTINCT {text} AS txt FROM {source})),
      {name} AS (
        SELECT txt, xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda c, b: {step}), 4294967295::BIGINT) AS crc
        FROM {name}_texts, crc_table t
      )"""


def _field(column: str) -> str:
    text = f"{column}::VARCHAR"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE octet_length(encode({text})) || ':' || {text} END"


def manifest() -> str:
    """Every level of the trees is one grouping; a node alone in its group stays as it is. Level 0 is the leaves, then the sources."""

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([_field("doc_id"), _field("source"), _field("lang"), _field("n_chars"), text.join(("CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || ", " END"))]) + ")"

    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    parts = [
        checksums("documents", "doc_id::VARCHAR"),
        f"""
      rows AS (
        SELECT doc_id, source, {leaf("text")} AS leaf,
          CASE WHEN crc % 5 = 0 THEN {leaf(f"translate(text, '{capitals}', '{capitals.lower()}')")} END AS tampered
        FROM documents LEFT JOIN crc ON txt = doc_id::VARCHAR
      ),
      leaves AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS id FROM rows),
      a0 AS (SELECT id, source, row_number() OVER (PARTITION BY source ORDER BY id) - 1 AS idx, leaf AS node, leaf AS own, '' AS proof, coalesce(tampered, leaf) AS folded FROM leaves)""",
    ]
    for k in range(_LEVELS):
        parts.append(_level(f"a{k}", f"a{k + 1}", "source"))
    last = f"a{_LEVELS}"
    parts.append(f"subroots AS (SELECT source, any_value(own) AS subroot FROM {last} GROUP BY source)")
    parts.append(
        f"""b0 AS (
        SELECT a.id, 0 AS source, dense_rank() OVER (ORDER BY a.source NULLS FIRST) - 1 AS idx, a.own AS node, a.own, a.proof, a.folded FROM {last} a
      )"""
    )
    for k in range(_LEVELS):
        parts.append(_level(f"b{k}", f"b{k + 1}", "source"))
    return f"""
    WITH {", ".join(parts)}
    SELECT l.doc_id, l.leaf, s.subroot, b.own AS root, sha256(b.proof) AS proof_sha256, b.folded AS folded_root, b.folded = b.own AS verified
    FROM b{_LEVELS} b JOIN leaves l ON l.id = b.id JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source"""


def _level(below: str, above: str, group: str) -> str:
    """Per leaf: the node above it, its proof with the siblings of the node, and the folded digest one level up."""
    return f"""
      {below}n AS (SELECT DISTINCT {group}, idx, own FROM {below}),
      {below}r AS (
        SELECT {group}, idx // 16 AS run, list(own ORDER BY idx) AS children, max(many) AS many
        FROM (SELECT *, count(*) OVER (PARTITION BY {group}) AS many FROM {below}n) GROUP BY {group}, idx // 16
      ),
      {above} AS (
        SELECT c.id, c.{group}, c.idx // 16 AS idx, c.node,
          CASE WHEN many > 1 THEN sha256(array_to_string(children, '')) ELSE own END AS own,
          CASE WHEN many > 1 THEN proof || array_to_string(children[1 : c.idx % 16], '') || array_to_string(children[c.idx % 16 + 2 :], '') ELSE proof END AS proof,
          CASE WHEN many > 1 THEN sha256(array_to_string(children[1 : c.idx % 16], '') || folded || array_to_string(children[c.idx % 16 + 2 :], '')) ELSE folded END AS folded
        FROM {below} c JOIN {below}r r ON c.{group} IS NOT DISTINCT FROM r.{group} AND c.idx // 16 = r.run
      )"""


def spelling() -> str:
    """Near words share a text with one code point masked, or one of them is the other without a code point."""
    return f"""
    WITH RECURSIVE runs AS (
      SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL
    ),
    keyed AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS id_run, run, times FROM runs),
    {checksums("keyed", "id_run")},
    spoiled AS (
      SELECT CASE WHEN crc % 97 = 0 THEN left(run, (crc % length(run))::INT) || substring(run, (crc % length(run))::INT + 2) ELSE run END AS word, times
      FROM keyed JOIN crc ON txt = id_run
    ),
    words AS (SELECT word, sum(times)::BIGINT AS n FROM spoiled WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
    cut AS (
      SELECT DISTINCT word, k, left(word, k - 1) AS head, substring(word, k + 1) AS rest
      FROM (SELECT word, unnest(range(1, length(word) + 1)) AS k FROM words)
    ),
    one_way AS (
      SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y ON x.head = y.head AND x.rest = y.rest AND x.k = y.k AND x.word < y.word
      UNION SELECT w.word, c.word FROM words w JOIN cut c ON w.word = c.head || c.rest
    ),
    near AS (SELECT a AS word, b AS other FROM one_way UNION ALL SELECT b, a FROM one_way),
    best AS (
      SELECT word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
        row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS place
      FROM near JOIN (SELECT word AS other_word, n FROM words) o ON other = other_word
    ),
    forms AS (
      SELECT words.word, CASE WHEN other_n >= 2 * n THEN other END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
      FROM words LEFT JOIN best ON words.word = best.word AND place = 1
    ),
    ways AS (
      SELECT word, word AS reached FROM forms
      UNION ALL SELECT ways.word, forms.form FROM ways JOIN forms ON reached = forms.word WHERE forms.form IS NOT NULL
    ),
    roots AS (SELECT ways.word, reached AS root FROM ways JOIN forms ON reached = forms.word WHERE form IS NULL)
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""


def archives() -> str:
    """Record type by payload: of equal ones of at least 1,000 bytes, the one with the largest page_id answers."""
    return """
    WITH bodies AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha1(coalesce(html, '')) AS sha FROM pages),
    answers AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS answer FROM bodies)
    SELECT page_id, size::BIGINT AS payload_bytes, sha AS payload_digest,
      CASE WHEN size >= 1000 AND page_id <> answer THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN size >= 1000 AND page_id <> answer THEN answer END AS refers_to
    FROM answers"""


def chat() -> str:
    """All turns, and the assistant's texts, of every conversation and of one more; an example is all turns up to an assistant's, or up to the last.

    A formatted turn has 16 characters of marks besides role and text, in which three characters are written as four or five more.
    """
    size = lambda c: f"length({c}) + 4 * (length({c}) - length(replace({c}, '&', ''))) + 3 * (length({c}) - length(replace({c}, '<', ''))) + 4 * (length({c}) - length(replace({c}, '[', '')))"
    return f"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(n)
    ), placed AS (
      SELECT *, sum(16 + {size("role")} + {size("text")}) OVER so_far AS chars,
        row_number() OVER so_far AS place, count(*) OVER (PARTITION BY conv_id) AS turns
      FROM turns WINDOW so_far AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
    ), whole AS (
      SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS said,
        sum(chars) FILTER (role = 'assistant' OR place = turns) AS formatted_chars
      FROM placed GROUP BY conv_id
    )
    SELECT conv_id, n_turns, turns_sha256, length(said)::BIGINT AS loss_chars, sha256(said) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM whole"""


def _grouped(links: str) -> str:
    """Table expressions: for the nodes of ``links`` (a, b; both ways) the smallest one that each reaches."""
    return f"""
    reached AS (SELECT DISTINCT a AS node, a AS there FROM {links} UNION SELECT node, b FROM reached JOIN {links} ON there = a),
    roots AS (SELECT node, min(there) AS root FROM reached GROUP BY node)"""


def near_vectors() -> str:
    """Every pair of different vectors, in double precision."""
    return f"""
    WITH RECURSIVE given AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    fine AS (
      SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM given
      WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
    ),
    links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM fine x JOIN fine y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v) WHERE list_dot_product(x.v, y.v) >= 0.95),
    {_grouped("links")}
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
    FROM given LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = vec_id LEFT JOIN roots ON node = vec_id"""


def near_documents() -> str:
    """Shingles of four words; documents that share one are compared on whole sets, equal sets as one."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    WITH RECURSIVE worded AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM documents
    ),
    sets AS (
      SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k : k + 3], ' ')) END)) AS s FROM worded
    ),
    numbered AS (SELECT doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN min(doc_id) OVER (PARTITION BY s) ELSE doc_id END AS rep, s FROM sets),
    classes AS (SELECT doc_id AS rep, n, s FROM numbered WHERE doc_id = rep AND n > 0),
    shingles AS (SELECT rep, n, unnest(s) AS g FROM classes),
    pairs AS (SELECT x.rep AS a, y.rep AS b, count(*) AS both_, x.n + y.n AS size FROM shingles x JOIN shingles y ON x.g = y.g AND x.rep <> y.rep AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n) GROUP BY x.rep, y.rep, x.n, y.n),
    links AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * both_ >= 80 * (size - both_)),
    {_grouped("links")}
    SELECT doc_id, n::BIGINT AS n_shingles, coalesce(root, rep) AS component_id, coalesce(root, rep) = doc_id AS kept FROM numbered LEFT JOIN roots ON node = rep"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc_members": archives(), "op5_rotated_codes": near_vectors(), "op6_prefix_target_chat": chat(), "op8_min_max_hashing": near_documents(),
        "op11_spelling_variants": spelling(), "op12_merkle_descent": manifest(),
    }
