"""The graph of the tables in SQL: v (vertices as last loaded and not removed since), e (edges once, with both vertices), u (undirected)."""

V = r"""
raw AS (SELECT id, label, properties AS p, loaded_at FROM vertices WHERE properties IS NOT NULL UNION ALL SELECT id, label, properties, loaded_at FROM base_vertices WHERE properties IS NOT NULL),
last AS (SELECT id, label, p, loaded_at FROM raw QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC, label, p.name, p.city) = 1),
v AS (SELECT id, label, p.name AS name, p.age AS age, p.birthDate AS birthDate, p.city AS city, p.lang AS lang, p.price AS price, p.headcount AS headcount, p.floor AS floor, p.establishmentYear AS establishmentYear, p.industry AS industry
  FROM last WHERE NOT EXISTS (SELECT 1 FROM vertex_removals r WHERE r.vertex_id = last.id AND r.label = last.label AND r.removed_at > last.loaded_at))"""

E = (
    V
    + r""",
ends AS (
  SELECT DISTINCT edge_id AS id, label, outVLabel, inVLabel, regexp_replace(outV, '^\s+|\s+$', '', 'g') AS o, regexp_replace(inV, '^\s+|\s+$', '', 'g') AS i,
    properties.date AS date, properties.city AS city, properties.weight AS weight, properties.shareholdingRatio AS shareholdingRatio FROM edges WHERE outV IS NOT NULL AND inV IS NOT NULL),
canon AS (
  SELECT x.*, CASE WHEN a.label IS NOT NULL AND starts_with(o, a.label || ':') THEN a.label_id || substr(o, length(a.label) + 1) ELSE o END AS src,
    CASE WHEN b.label IS NOT NULL AND starts_with(i, b.label || ':') THEN b.label_id || substr(i, length(b.label) + 1) ELSE i END AS dst
  FROM ends x LEFT JOIN vertexlabels a ON x.outVLabel = a.label AND len(a.primary_keys) > 0 LEFT JOIN vertexlabels b ON x.inVLabel = b.label AND len(b.primary_keys) > 0),
e AS (SELECT c.id, c.label, src, dst, date, c.city, weight, shareholdingRatio FROM canon c JOIN v a ON a.id = src AND a.label = outVLabel JOIN v b ON b.id = dst AND b.label = inVLabel)"""
)


def undirected(labels: tuple[str, ...], every: bool = False) -> str:
    """v, e and u over the edges of some labels, or of every label, and s: the smallest source of the first label."""
    some = "" if every else "WHERE label IN (" + ", ".join(f"'{x}'" for x in labels) + ")"
    return E + f""",
u AS (SELECT src, dst FROM e {some} UNION SELECT dst, src FROM e {some}),
s AS (SELECT min(src) AS s FROM e WHERE label = '{labels[0]}')"""


#: Searches that go on until no node is new: (key, n, d), each n at its least distance from the key's start.
def levels(name: str, start: str, step: str, key: str = "k") -> str:
    """A recursion whose rows start as `start` ({key}, n, d) and move along `step` (a relation with {key}, src, dst, or src, dst)."""
    same = f" AND x.{key} = b.{key}" if step != "u" else ""
    return f"""{name}({key}, n, d) USING KEY ({key}, n) AS ({start} UNION
SELECT DISTINCT b.{key}, x.dst, b.d + 1 FROM {name} b JOIN {step} x ON x.src = b.n{same} WHERE NOT EXISTS (SELECT 1 FROM recurring.{name} r WHERE r.{key} = b.{key} AND r.n = x.dst))"""
