"""DuckDB SQL for the queries that SQL can express, restated from their definitions."""

from __future__ import annotations

from .chat import Settings as Chat
from .lines import Settings as Lines
from .merkle import FIELDS
from .merkle import Settings as Merkle
from .mixing import Settings as Mixing
from .trie import Settings as Trie
from .warc import Settings as Warc

WORDS = r"len(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'))"

LINE_DEDUP = f"""WITH every AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
l AS (
  SELECT *, row_number() OVER d AS ord, sum(words) OVER d AS upto
  FROM (SELECT *, {WORDS.format("line")} AS words FROM every) WHERE words > 0
  WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
shortest AS (
  SELECT a.doc_id, a.ord AS first, min(b.ord) AS last FROM l a JOIN l b
  ON a.doc_id = b.doc_id AND b.ord >= a.ord AND b.upto - a.upto + a.words >= {Lines().min_words} GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.ord), b.ord FROM l a JOIN l b
  ON a.doc_id = b.doc_id AND b.ord >= a.ord AND b.upto - a.upto + a.words >= {Lines().min_words}
  GROUP BY b.doc_id, b.ord),
spelt AS (
  SELECT s.doc_id, s.first, s.last, string_agg(line, chr(10) ORDER BY ord) AS run FROM shortest s JOIN l
  ON l.doc_id = s.doc_id AND l.ord BETWEEN s.first AND s.last GROUP BY ALL),
copies AS (
  SELECT * FROM spelt QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, first) > 1),
gone AS (
  SELECT DISTINCT l.doc_id, l.pos, l.words FROM l JOIN copies c
  ON l.doc_id = c.doc_id AND l.ord BETWEEN c.first AND c.last),
rest AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM every ANTI JOIN gone USING (doc_id, pos)
  GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE ifnull(rest.text, '') END AS text,
  ifnull(n_lines, 0) AS n_lines, ifnull(n_removed, 0) AS n_removed, ifnull(words_removed, 0) AS words_removed
FROM documents d LEFT JOIN rest USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n_lines FROM l GROUP BY 1) USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n_removed, CAST(sum(words) AS BIGINT) AS words_removed
           FROM gone GROUP BY 1) USING (doc_id)"""


def chat_windows(s: Chat = Chat()) -> str:
    def escaped(c: str) -> str:
        return f"length({c}) + length({c}) - length(replace(replace(replace({c}, '\\', ''), '<', ''), '|', ''))"
    held = "1"
    behind = "n"
    for d in range(1, s.history_turns + 1):
        if d > 1:
            behind += f" + lead(n, {d - 1}) OVER c"
        earlier = "span" if d == 1 else f"lead(span, {d - 1}) OVER c"
        held += (f" + CASE WHEN lead(span, {d}) OVER c <> {earlier} AND {behind} <= {s.history_tokens} "
                 f"AND NOT lead(n, {d}) OVER c > {s.stride} THEN 1 ELSE 0 END")
    said = "'</s>[INST] ok [/INST]'"
    return f"""WITH t AS (
  SELECT conv_id, turn, ifnull(role, '') AS role, ifnull(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', {said}), (-7, 1, 'assistant', {said})),
placed AS (
  SELECT *, {WORDS.format("text")} + {s.turn_tokens} AS n,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM t),
marked AS (
  SELECT *, max(CASE WHEN is_system THEN n ELSE 0 END) OVER (PARTITION BY conv_id) AS system_n,
         NOT is_system AND n > {s.stride} AND n + system_n > {s.budget} AS alone
  FROM (SELECT *, pos = 1 AND role = '{s.system_role}' AND n <= {s.system_share} AS is_system FROM placed)),
summed AS (
  SELECT *, ifnull(sum(CASE WHEN is_system THEN 0 ELSE n END) OVER (
    PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM marked),
cut AS (
  SELECT *, CASE WHEN is_system THEN NULL ELSE 2 * (before // {s.stride})
    + CASE WHEN before + n > (before // {s.stride} + 1) * {s.stride} THEN 1 ELSE 0 END END AS piece FROM summed),
spans AS (
  SELECT *, sum(CASE WHEN changed THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY pos) AS span
  FROM (SELECT *, piece <> lag(piece) OVER (PARTITION BY conv_id ORDER BY pos)
               OR (pos = 2 AND system_n > 0 AND alone) AS changed FROM cut)),
counted AS (
  SELECT *, max(span) OVER (PARTITION BY conv_id) + 1 AS windows, count(*) FILTER (alone) OVER (PARTITION BY conv_id) AS full_ones,
         CASE WHEN is_system THEN NULL ELSE {held} END AS held FROM spans
  WINDOW c AS (PARTITION BY conv_id ORDER BY pos))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  ifnull(sum(length(text)) FILTER (role = '{s.target_role}'), 0)::BIGINT AS loss_chars,
  sha256(ifnull(string_agg(text, '' ORDER BY pos) FILTER (role = '{s.target_role}'), '')) AS loss_sha256,
  (3 * max(windows) + sum(ifnull(held, windows - full_ones) * (8 + {escaped("role")} + {escaped("text")})))::BIGINT AS formatted_chars
FROM counted GROUP BY conv_id"""


def source_mix(s: Mixing = Mixing()) -> str:
    weights = "[" + ", ".join(f"{float(w)}::DOUBLE" for w in s.weights) + "]"
    return f"""WITH d AS (
  SELECT doc_id, ifnull('0' || source, '1') AS src, {WORDS.format("ifnull(text, '')")}::BIGINT AS size,
         md5(ifnull(doc_id::VARCHAR, 'null|' || md5(ifnull(text, '')))) AS h FROM documents),
per AS (SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src),
w AS (SELECT *, {weights}[(row_number() OVER (ORDER BY src) - 1) % {len(s.weights)} + 1] AS weight,
             {float(s.max_copies)}::DOUBLE * source_size AS most FROM per),
levels AS (
  SELECT *, ({float(s.total_share)}::DOUBLE * sum(source_size) OVER () - ifnull(sum(most) OVER earlier, 0))
    / (sum(weight) OVER () - ifnull(sum(weight) OVER earlier, 0)) AS level FROM w
  WINDOW earlier AS (ORDER BY most / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT src, source_size, CASE WHEN most <= level * weight THEN most
    ELSE max(CASE WHEN most > level * weight THEN level END) OVER () * weight END AS target FROM levels),
laid AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio,
         row_number() OVER (PARTITION BY src ORDER BY size, h)::DOUBLE AS place,
         (('0x' || substring(md5('{s.seed}|' || src), 1, 4))::INTEGER + 0.5) / 65536 AS shift
  FROM d JOIN targets USING (src))
SELECT doc_id, size, source_size, target,
  ((floor(shift + place * ratio) - floor(shift + (place - 1) * ratio)) * size)::BIGINT AS taken FROM laid"""


def crc32(number: str) -> str:
    """Unsigned CRC-32 of a number's decimal text, bit by bit."""
    text = f"CAST({number} AS VARCHAR)"
    codes = f"list_transform(range(1, strlen({text}) + 1), lambda i: ord(substr({text}, CAST(i AS INTEGER), 1))::BIGINT)"
    one = ("list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), "
           "lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)")
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda a, b: {one}), 4294967295)"


def conversation_trie(s: Trie = Trie()) -> str:
    return f"""WITH t AS (
  SELECT conv_id AS c, turn, ifnull(role, '') AS role, ifnull(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, list(md5(length(role) || ':' || role || text) ORDER BY turn NULLS FIRST, role, text) AS ids,
         list(length(text) ORDER BY turn NULLS FIRST, role, text) AS sizes FROM t GROUP BY c),
h AS (SELECT *, {crc32("c")} % {s.shared_most} AS h FROM own),
seqs AS (
  SELECT a.c, list_concat(ifnull(b.ids[1:a.h], []), a.ids[a.h + 1:]) AS ids,
         list_concat(ifnull(b.sizes[1:a.h], []), a.sizes[a.h + 1:]) AS sizes
  FROM h a LEFT JOIN own b ON b.c = a.c - a.c % {s.shared_every}),
pre AS (
  SELECT c, d, array_to_string(ids[1:d], '') AS p, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(ids) AS ending
  FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM seqs)),
node AS (
  SELECT p, any_value(d) AS d, any_value(size) AS size, min(c) AS conv_id, count(*) AS n,
         sha256(ifnull(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ending), '')) AS ends FROM pre GROUP BY p),
kids AS (SELECT left(p, 32 * (d - 1)) AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
marked AS (SELECT node.*, ifnull(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (p)),
below AS (
  SELECT left(p, 32 * j) AS p, sum((n - 1) * size)::BIGINT AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(d + 1)) AS j FROM marked) GROUP BY 1)
SELECT m.conv_id, m.d AS depth, o.conv_id AS parent_conv_id, m.n AS n_convs, m.n_children, leaves AS n_leaves,
  saved AS saved_tokens, m.ends AS ends_sha256
FROM marked m JOIN below USING (p) LEFT JOIN node o ON m.d > 0 AND o.p = left(m.p, 32 * (m.d - 1))"""


def archives(s: Warc = Warc()) -> str:
    return f"""WITH p AS (
  SELECT page_id, strlen(ifnull(html, '')) AS payload_bytes, sha1(ifnull(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= {s.min_payload} THEN max(page_id) OVER (PARTITION BY payload_digest) END AS newest FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < newest THEN newest END AS refers_to FROM f"""


def merkle_proofs(s: Merkle = Merkle(), levels: int = 12) -> str:
    """Levels are spelt out: ``arity ** levels`` rows at most, per group and of groups."""
    def leaf(text: str) -> str:
        each = [text if c == "text" else c for c in FIELDS]
        told = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END" for c in each]
        return f"sha256({' || '.join(told)})"

    def tree(x: str, first: str) -> tuple[str, list[str]]:
        """Nodes ``x0, x1 ...`` (group g, place i, digest h, nodes m of the level) over the first ones, their runs, and the tops."""
        ctes = [f"{x}0 AS ({first})"]
        for n in range(levels):
            ctes += [f"{x}run{n} AS (SELECT g, i // {s.arity} AS run, list(h ORDER BY i) AS hs, any_value(m) AS m "
                     f"FROM {x}{n} WHERE m > 1 GROUP BY ALL)",
                     f"{x}{n + 1} AS (SELECT g, run AS i, sha256(array_to_string(hs, '')) AS h, "
                     f"(m + {s.arity - 1}) // {s.arity} AS m FROM {x}run{n})"]
        every = " UNION ALL ".join(f"SELECT g, h FROM {x}{n} WHERE m = 1" for n in range(levels + 1))
        return f"{x}top", [*ctes, f"{x}top AS ({every})"]

    def walk(w: str, x: str, start: str) -> list[str]:
        """Rows of ``start`` (place i in group g, digest acc, siblings so far) led up the tree."""
        ctes, now = [], start
        for n in range(levels):
            k = f"w.i % {s.arity}"
            left, right = f"array_to_string(hs[1:{k}], '')", f"array_to_string(hs[{k} + 2:], '')"
            ctes.append(f"""{w}{n} AS (SELECT w.* REPLACE (w.i // {s.arity} AS i,
  CASE WHEN hs IS NULL THEN w.acc ELSE sha256({left} || w.acc || {right}) END AS acc,
  CASE WHEN hs IS NULL THEN w.siblings ELSE w.siblings || {left} || {right} END AS siblings)
  FROM {now} w LEFT JOIN {x}run{n} r ON r.g = w.g AND r.run = w.i // {s.arity})""")
            now = f"{w}{n}"
        return ctes
    group = "CASE WHEN source IS NULL THEN '0' ELSE '1' || source END"
    plain = leaf("text")
    found = f"CASE WHEN {crc32('doc_id')} % 2 = 0 THEN {leaf('replace(text, chr(10), ' + chr(39) * 2 + ')')} ELSE {plain} END"
    top, own = tree("s", "SELECT g, i, h, m FROM d")
    last, over = tree("r", f"SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS i, h, count(*) OVER () AS m FROM {top}")
    ctes = [f"""d AS (SELECT doc_id, {group} AS g, {plain} AS h, {found} AS acc, '' AS siblings,
  row_number() OVER (PARTITION BY {group} ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY {group}) AS m FROM documents)""",
            *own, *walk("a", "s", "d"), *over,
            f"""met AS (SELECT a.* REPLACE (0 AS g, p.i AS i), subroot FROM a{levels - 1} a
  JOIN (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i FROM {top}) p ON p.g = a.g)""",
            *walk("b", "r", "met")]
    return f"""WITH {", ".join(ctes)}
SELECT doc_id, h AS leaf, subroot, (SELECT h FROM {last}) AS root, sha256(siblings) AS proof_sha256, acc AS folded_root,
  acc = (SELECT h FROM {last}) AS verified FROM b{levels - 1}"""


ORACLE = {"op1_line_dedup": LINE_DEDUP, "op7_chat_windows": chat_windows(), "op10_source_mix": source_mix(),
          "op11_conversation_trie": conversation_trie(), "op12_warc_archives": archives(), "op13_merkle_proofs": merkle_proofs()}
