"""SQL that DuckDB runs on the given tables to check each registered query."""

from __future__ import annotations

# Derived meshes, in the same terms as meshwright.plans.derive.
MESHES = """
fx_vertices as (
  select user_id as mesh_id,
         cast(row_number() over (partition by user_id order by event_id) - 1 as bigint) as vid,
         value as x, cast(hour(ts) * 60 + minute(ts) as double) as y,
         cast(event_id % 50 as double) as z, event_type
  from events),
fx_n as (select mesh_id, cast(count(*) as bigint) as nv from fx_vertices group by mesh_id),
fx_vertices_q as (
  select mesh_id, vid, cast(floor(x / 25.0) as double) as x, cast(floor(y / 240.0) as double) as y,
         cast(cast(z as bigint) % 4 as double) as z from fx_vertices),
fx_faces as (
  select v.mesh_id, v.vid as fid, v.vid as a, v.vid + 1 as b, v.vid + 2 as c
  from fx_vertices v join fx_n n on v.mesh_id = n.mesh_id where v.vid + 2 < n.nv),
fx_faces_s as (
  select v.mesh_id, v.vid as fid, v.vid % 12 as a, (v.vid * 7 + 3) % n.nv as b,
         (v.vid * 11 + 5) % 9 as c
  from fx_vertices v join fx_n n on v.mesh_id = n.mesh_id where v.vid % 3 = 0)
"""


def edges_of(faces: str, name: str = "edges") -> str:
    return f"""
{name}_sides as (
  select mesh_id, least(a, b) as lo, greatest(a, b) as hi from {faces}
  union all select mesh_id, least(b, c), greatest(b, c) from {faces}
  union all select mesh_id, least(a, c), greatest(a, c) from {faces}),
{name} as (
  select mesh_id, lo, hi, cast(count(*) as bigint) as k from {name}_sides group by mesh_id, lo, hi)
"""


def lengths_of(edges: str, vertices: str, name: str = "lengths") -> str:
    return f"""
{name} as (
  select e.mesh_id, e.lo, e.hi, e.k,
         sqrt((p.x-q.x)*(p.x-q.x) + (p.y-q.y)*(p.y-q.y) + (p.z-q.z)*(p.z-q.z)) as length
  from {edges} e
  join {vertices} p on p.mesh_id = e.mesh_id and p.vid = e.lo
  join {vertices} q on q.mesh_id = e.mesh_id and q.vid = e.hi)
"""


def areas_of(faces: str, vertices: str, name: str = "areas") -> str:
    return f"""
{name}_cross as (
  select f.mesh_id, f.fid, f.a, f.b, f.c,
    (q.y-p.y)*(r.z-p.z) - (q.z-p.z)*(r.y-p.y) as cx,
    (q.z-p.z)*(r.x-p.x) - (q.x-p.x)*(r.z-p.z) as cy,
    (q.x-p.x)*(r.y-p.y) - (q.y-p.y)*(r.x-p.x) as cz
  from {faces} f
  join {vertices} p on p.mesh_id = f.mesh_id and p.vid = f.a
  join {vertices} q on q.mesh_id = f.mesh_id and q.vid = f.b
  join {vertices} r on r.mesh_id = f.mesh_id and r.vid = f.c),
{name} as (select *, sqrt(cx*cx + cy*cy + cz*cz) as double_area from {name}_cross)
"""


def normals_of(areas: str, vertices: str, name: str = "normals") -> str:
    return f"""
{name}_unit as (
  select mesh_id, a, b, c,
    case when double_area > 0 then cx / double_area else 0 end as ux,
    case when double_area > 0 then cy / double_area else 0 end as uy,
    case when double_area > 0 then cz / double_area else 0 end as uz from {areas}),
{name}_sum as (
  select mesh_id, vid, sum(ux) as sx, sum(uy) as sy, sum(uz) as sz from (
    select mesh_id, a as vid, ux, uy, uz from {name}_unit
    union all select mesh_id, b, ux, uy, uz from {name}_unit
    union all select mesh_id, c, ux, uy, uz from {name}_unit) group by mesh_id, vid),
{name}_len as (
  select v.mesh_id, v.vid, coalesce(sx, 0) as sx, coalesce(sy, 0) as sy, coalesce(sz, 0) as sz,
    sqrt(coalesce(sx*sx + sy*sy + sz*sz, 0)) as len
  from {vertices} v left join {name}_sum s on s.mesh_id = v.mesh_id and s.vid = v.vid),
{name} as (
  select mesh_id, vid, case when len > 0 then sx / len else 0 end as nx,
    case when len > 0 then sy / len else 0 end as ny,
    case when len > 0 then sz / len else 0 end as nz from {name}_len)
"""


def query(*ctes: str, body: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{', '.join(c.strip() for c in ctes)} {body}"


def r(expression: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + cast(0.0 as double)"


EXPECTED_EDGE_MM = 1.2

SQL: dict[str, str] = {}

SQL["mesh_edge_metrics"] = query(
    MESHES, edges_of("fx_faces"), lengths_of("edges", "fx_vertices"),
    body=f"""
select mesh_id, cast(count(*) as bigint) as edge_count,
  cast(count(*) filter (where k = 1) as bigint) as boundary_edge_count,
  cast(count(*) filter (where k > 2) as bigint) as nonmanifold_edge_count,
  {r('avg(length)')} as mean_mm, {r('quantile_cont(length, 0.5)')} as median_mm,
  {r('quantile_cont(length, 0.05)')} as p05_mm, {r('quantile_cont(length, 0.95)')} as p95_mm
from lengths group by mesh_id""")

SQL["mesh_edge_list"] = query(
    MESHES, edges_of("fx_faces_s"), body="select mesh_id, lo, hi, k from edges")

SQL["mesh_edge_mad"] = query(
    MESHES, edges_of("fx_faces"), lengths_of("edges", "fx_vertices"),
    "med as (select mesh_id, median(length) as median from lengths group by mesh_id)",
    body=f"""
select l.mesh_id, {r('min(m.median)')} as median_mm, {r('median(abs(l.length - m.median))')} as mad_mm
from lengths l join med m on m.mesh_id = l.mesh_id group by l.mesh_id""")

SQL["mesh_boundary_vertices"] = query(
    MESHES, edges_of("fx_faces_s"), body="""
select distinct mesh_id, vid from (
  select mesh_id, lo as vid from edges where k = 1
  union all select mesh_id, hi from edges where k = 1)""")

SQL["mesh_nonmanifold_edges"] = query(
    MESHES, edges_of("fx_faces_s"), body="select mesh_id, lo, hi, k from edges where k > 2")

SQL["mesh_face_area_stats"] = query(
    MESHES, areas_of("fx_faces_s", "fx_vertices"), body=f"""
select mesh_id, cast(count(*) as bigint) as face_count,
  cast(count(*) filter (where double_area <= 1e-12) as bigint) as degenerate_face_count,
  {r('avg(case when double_area <= 1e-12 then 1.0 else 0.0 end)')} as zero_face_normal_fraction,
  {r('sum(double_area) * 0.5', 4)} as surface_area_mm2
from areas group by mesh_id""")

SQL["mesh_bad_triangles"] = query(
    MESHES, areas_of("fx_faces", "fx_vertices"),
    """z as (select a.*, (double_area*0.5 - avg(double_area*0.5) over (partition by mesh_id))
         / nullif(stddev_pop(double_area*0.5) over (partition by mesh_id), 0) as z from areas a)""",
    body="""
select distinct mesh_id, vid from (
  select mesh_id, a as vid from z where abs(z) > 1.5
  union all select mesh_id, b from z where abs(z) > 1.5
  union all select mesh_id, c from z where abs(z) > 1.5)""")

SQL["mesh_vertex_normals"] = query(
    MESHES, areas_of("fx_faces_s", "fx_vertices"), normals_of("areas", "fx_vertices"),
    body=f"select mesh_id, vid, {r('nx')} as nx, {r('ny')} as ny, {r('nz')} as nz from normals")

SQL["mesh_duplicate_geometry"] = query(
    MESHES,
    """dv as (select mesh_id, count(*) - count(distinct (cast(x as varchar), cast(y as varchar), cast(z as varchar))) as d
          from fx_vertices_q group by mesh_id)""",
    """df as (select mesh_id, count(*) - count(distinct list_sort([a, b, c])) as d
          from fx_faces_s group by mesh_id)""",
    body="""
select dv.mesh_id, cast(dv.d as bigint) as duplicate_vertices, cast(coalesce(df.d, 0) as bigint) as duplicate_faces
from dv left join df on df.mesh_id = dv.mesh_id""")

SQL["mesh_extent_density"] = query(
    MESHES, areas_of("fx_faces", "fx_vertices"),
    """ext as (select mesh_id, count(*) as nv, max(x)-min(x) as ex, max(y)-min(y) as ey, max(z)-min(z) as ez
          from fx_vertices group by mesh_id)""",
    "ar as (select mesh_id, sum(double_area) * 0.5 as area from areas group by mesh_id)",
    body=f"""
select e.mesh_id, {r('ex')} as extent_x_mm, {r('ey')} as extent_y_mm, {r('ez')} as extent_z_mm,
  {r('nv / nullif(ex * ey * ez, 0)', 10)} as vertices_per_mm3,
  {r('nv / nullif(area, 0)', 10)} as vertices_per_mm2
from ext e join ar a on a.mesh_id = e.mesh_id""")

COMPONENTS = """
links as (select mesh_id, lo as u, hi as v from edges union select mesh_id, hi, lo from edges),
reach as (
  select mesh_id, vid, vid as root from fx_vertices
  union
  select r.mesh_id, l.v, r.root from reach r join links l on l.mesh_id = r.mesh_id and l.u = r.vid
  where r.root <= l.v),
labels as (select mesh_id, vid, min(root) as label from reach group by mesh_id, vid),
sizes as (select mesh_id, label, count(*) as size from labels group by mesh_id, label)
"""

SQL["mesh_components"] = query(
    MESHES, edges_of("fx_faces_s"), COMPONENTS, recursive=True,
    body="select mesh_id, label, cast(size as bigint) as size from sizes")

SQL["mesh_largest_component"] = query(
    MESHES, edges_of("fx_faces_s"), COMPONENTS, recursive=True, body="""
select mesh_id, label, size from (
  select mesh_id, label, cast(size as bigint) as size,
    row_number() over (partition by mesh_id order by size desc, label) as rn from sizes) where rn = 1""")

# --- measurements and quality rules -------------------------------------------

STRIP_STATS = f"""
{edges_of('fx_faces')}, {lengths_of('edges', 'fx_vertices')}, {areas_of('fx_faces', 'fx_vertices')},
{normals_of('areas', 'fx_vertices')}, {COMPONENTS},
es as (select mesh_id, cast(count(*) as double) as edge_count,
    cast(count(*) filter (where k = 1) as double) as boundary,
    cast(count(*) filter (where k > 2) as double) as nonmanifold, avg(length) as mean,
    quantile_cont(length, 0.5) as median, quantile_cont(length, 0.05) as p05,
    quantile_cont(length, 0.95) as p95 from lengths group by mesh_id),
ms as (select l.mesh_id, median(abs(l.length - e.median)) as mad
    from lengths l join es e on e.mesh_id = l.mesh_id group by l.mesh_id),
fs as (select mesh_id, sum(double_area) * 0.5 as area,
    cast(count(*) filter (where double_area <= 1e-12) as double) as flat,
    avg(case when double_area <= 1e-12 then 1.0 else 0.0 end) as flat_fraction
    from areas group by mesh_id),
ds as (select mesh_id, cast(count(*) as double) as nv,
    cast(count(*) - count(distinct (cast(x as varchar), cast(y as varchar), cast(z as varchar))) as double) as dup_v,
    max(x)-min(x) as ex, max(y)-min(y) as ey, max(z)-min(z) as ez from fx_vertices group by mesh_id),
dq as (select mesh_id, cast(count(*) - count(distinct list_sort([a, b, c])) as double) as dup_f from fx_faces group by mesh_id),
cs as (select mesh_id, cast(count(*) as double) as comps, cast(max(size) as double) as largest from sizes group by mesh_id),
ns as (select mesh_id, avg(case when nx = 0 and ny = 0 and nz = 0 then 1.0 else 0.0 end) as zero_n from normals group by mesh_id),
stats as (select * from es join ms using (mesh_id) join fs using (mesh_id) join ds using (mesh_id)
    join dq using (mesh_id) join cs using (mesh_id) join ns using (mesh_id))
"""

_METRICS = [
    ("input.edge_length.expected_mm", "cast(1.2 as double)", "mm"),
    ("input.edge_length.mean_mm", "mean", "mm"),
    ("input.edge_length.median_mm", "median", "mm"),
    ("input.edge_length.p05_mm", "p05", "mm"),
    ("input.edge_length.p95_mm", "p95", "mm"),
    ("input.edge_length.mad_mm", "mad", "mm"),
    ("input.edge_length.median_to_expected_ratio", "median / cast(1.2 as double)", "ratio"),
    ("input.degenerate_faces.count", "flat", "count"),
    ("input.duplicate_geometry.vertex_count", "dup_v", "count"),
    ("input.duplicate_geometry.face_count", "dup_f", "count"),
    ("input.connected_components.count", "comps", "count"),
    ("input.connected_components.largest_fraction", "largest / nv", "ratio"),
    ("input.topology.boundary_edge_count", "boundary", "count"),
    ("input.topology.boundary_edge_fraction", "boundary / edge_count", "ratio"),
    ("input.topology.nonmanifold_edge_count", "nonmanifold", "count"),
    ("input.extent_density.extent_x_mm", "ex", "mm"),
    ("input.extent_density.extent_y_mm", "ey", "mm"),
    ("input.extent_density.extent_z_mm", "ez", "mm"),
    ("input.extent_density.vertices_per_mm3", "nv / nullif(ex * ey * ez, 0)", "count/mm3"),
    ("input.extent_density.surface_area_mm2", "area", "mm2"),
    ("input.extent_density.vertices_per_mm2", "nv / nullif(area, 0)", "count/mm2"),
    ("input.normal_consistency.zero_normal_fraction", "zero_n", "ratio"),
    ("input.normal_consistency.zero_face_normal_fraction", "flat_fraction", "ratio"),
]
MEASURED = "measured as (" + " union all ".join(
    f"select cast(mesh_id as varchar) as output_key, '{m}' as metric, {e} as value, '{u}' as unit, "
    f"case when {e} is null then 'not_applicable' else 'computed' end as compute_status from stats"
    for m, e, u in _METRICS
) + ")"

SQL["mesh_input_measurements"] = query(
    MESHES, STRIP_STATS, MEASURED, recursive=True,
    body=f"select output_key, metric, {r('value', 5)} as value, unit, compute_status from measured")

SQL["mesh_component_vertex_counts"] = query(
    MESHES, edges_of("fx_faces_s"), COMPONENTS, recursive=True, body="""
select mesh_id, cast(size as bigint) as size, cast(count(*) as bigint) as components
from sizes group by mesh_id, size""")

_VERDICT_RULES = [
    ("edge_ratio", "median / cast(1.2 as double) > 400", True),
    ("edge_mad", "mad > 210", True),
    ("split", "comps > 1", True),
    ("open", "not (boundary / edge_count between 0.4 and 0.6)", True),
    ("doubles", "dup_v > 0", False),
    ("tall", "ey < 1390", True),
]
SQL["mesh_quality_verdict"] = query(
    MESHES, STRIP_STATS, recursive=True, body=f"""
select cast(mesh_id as varchar) as output_key,
  case when {' or '.join(f'({c})' for _, c, w in _VERDICT_RULES if w)} then 'warning' else 'passed' end as status,
  false as qc_incomplete,
  concat_ws(',', {', '.join(f"case when {c} then '{n}' end" for n, c, _ in _VERDICT_RULES)}) as triggered_rules
from stats""")

MEASUREMENTS = """
fx_measurements as (
  select cast(user_id as varchar) as output_key,
    case event_type when 'view' then 'input.edge_length.median_mm'
      when 'click' then 'crop.retention.vertex_fraction'
      when 'signup' then 'landmark.anatomy.nose_height_mm'
      when 'purchase' then 'gpa.transform.scale'
      when 'error' then 'registration.deformation.mean_mm' end as metric,
    round(avg(value), 6) as value_double,
    case when event_type in ('click', 'purchase') then 'ratio' else 'mm' end as unit,
    case when event_type = 'view' and user_id % 11 = 0 then 'not_available'
      when event_type = 'error' and user_id % 13 = 0 then 'computation_error'
      else 'computed' end as compute_status
  from events where not (event_type = 'signup' and user_id % 17 = 0)
  group by user_id, event_type)
"""

_EVENT_RULES = """
rules(rule_ord, rule_id, metric, op, lo, hi, unit, severity, enhanced) as (values
  (0, 'edge_high', 'input.edge_length.median_mm', 'gt', 62.0, null, 'mm', 'warning', false),
  (1, 'retention_band', 'crop.retention.vertex_fraction', 'outside', 30.0, 70.0, 'ratio', 'warning', false),
  (2, 'nose_low', 'landmark.anatomy.nose_height_mm', 'lt', 45.0, null, 'mm', 'record_only', false),
  (4, 'deform_unit', 'registration.deformation.mean_mm', 'lte', 30.0, null, 'ratio', 'warning', false),
  (5, 'deform_high', 'registration.deformation.mean_mm', 'gt', 52.0, null, 'mm', 'warning', true)),
keys as (select output_key, bool_or(compute_status in ('error', 'computation_error', 'not_computed')) as any_error
         from fx_measurements group by output_key),
judged as (
  select k.output_key, k.any_error, u.rule_ord, u.rule_id, u.metric, u.severity, u.enhanced,
    case when m.metric is null then 'measurement missing'
      when m.compute_status <> 'computed' then 'measurement ' || m.compute_status || ': no detail'
      when m.unit <> u.unit then 'unit mismatch: expected ' || u.unit || ', got ' || m.unit end as problem,
    case u.op when 'gt' then m.value_double > u.lo when 'lt' then m.value_double < u.lo
      when 'lte' then m.value_double <= u.lo
      when 'outside' then not (m.value_double >= u.lo and m.value_double <= u.hi) end as matched
  from keys k cross join rules u
  left join fx_measurements m on m.output_key = k.output_key and m.metric = u.metric),
results as (
  select output_key, any_error, rule_ord, rule_id, metric, enhanced, problem is null as evaluated,
    case when problem is null then not matched end as passed,
    case when problem is null then matched else true end as triggered,
    case when problem is null then severity else 'warning' end as severity,
    coalesce(problem, case when matched then 'trigger condition matched' else 'trigger condition not matched' end) as reason
  from judged)
"""
_STATUS = """
verdicts as (
  select output_key, bool_or(any_error) or bool_or(not evaluated) as qc_incomplete,
    coalesce(string_agg(case when triggered then rule_id end, ',' order by rule_ord), '') as triggered_rules,
    case when bool_or(any_error) or bool_or(not evaluated) or bool_or(triggered and severity = 'warning')
      then 'warning' else 'passed' end as status
  from results where not enhanced and rule_id <> 'deform_unit' group by output_key)
"""

SQL["qc_measurements_long"] = query(
    MEASUREMENTS, body="select output_key, metric, value_double, unit, compute_status from fx_measurements")
SQL["qc_metric_group"] = query(
    MEASUREMENTS, body="""
select regexp_replace(metric, '\\.[^.]*$', '') as metric_group, cast(count(*) as bigint) as n
from fx_measurements group by 1""")
SQL["qc_rule_results"] = query(
    MEASUREMENTS, _EVENT_RULES, body="""
select output_key, rule_id, metric, evaluated, passed, triggered, severity, reason
from results where not enhanced""")
SQL["qc_rule_results_enhanced"] = query(
    MEASUREMENTS, _EVENT_RULES, body="""
select rule_id, severity, cast(count(*) as bigint) as n,
  cast(count(*) filter (where evaluated) as bigint) as evaluated,
  cast(count(*) filter (where triggered) as bigint) as triggered
from results group by rule_id, severity""")
SQL["qc_sample_status"] = query(
    MEASUREMENTS, _EVENT_RULES, _STATUS,
    body="select output_key, status, qc_incomplete, triggered_rules from verdicts")
SQL["qc_status_counts"] = query(
    MEASUREMENTS, _EVENT_RULES, _STATUS,
    body="select status, cast(count(*) as bigint) as samples from verdicts group by status")
SQL["qc_run_counts"] = query(
    MEASUREMENTS, _EVENT_RULES, _STATUS, body="""
select cast(count(*) as bigint) as sample_count,
  cast(count(*) filter (where status = 'passed') as bigint) as passed,
  cast(count(*) filter (where status = 'warning') as bigint) as warning,
  cast(count(*) filter (where status = 'failed') as bigint) as failed from verdicts""")


def _distribution(source: str, metric: str, unit: str, value: str) -> str:
    ranks = {"p01": 0.01, "p05": 0.05, "median": 0.5, "p95": 0.95, "p99": 0.99}
    picks = ", ".join(f"{r(f'quantile_cont({value}, {p})')} as {n}" for n, p in ranks.items())
    return (f"select {metric} as metric, {unit} as unit, cast(count(*) as bigint) as n, "
            f"{r(f'min({value})')} as min, {r(f'max({value})')} as max, {picks} from {source} group by 1, 2")


SQL["qc_calibration"] = query(MEASUREMENTS, body=_distribution(
    "(select * from fx_measurements where compute_status = 'computed')", "metric", "unit", "value_double"))
SQL["qc_value_distribution"] = _distribution("events", "event_type", "'mm'", "value")
SQL["qc_labeled_performance"] = f"""
with joined as (
  select l.quality = 0 as wrong, d.n_chars < 400 as flagged
  from documents d join labels l on l.doc_id = d.doc_id)
select cast(count(*) as bigint) as evaluable_count,
  cast(count(*) filter (where flagged and wrong) as bigint) as true_positive,
  cast(count(*) filter (where flagged and not wrong) as bigint) as false_positive,
  cast(count(*) filter (where not flagged and not wrong) as bigint) as true_negative,
  cast(count(*) filter (where not flagged and wrong) as bigint) as false_negative,
  {r('count(*) filter (where flagged and wrong) / nullif(count(*) filter (where wrong), 0)')} as unacceptable_detection_rate,
  {r('count(*) filter (where flagged and not wrong) / nullif(count(*) filter (where not wrong), 0)')} as acceptable_warning_rate
from joined"""
SQL["blinded_sample"] = """
select format('B{:05d}', rn) as blind_id, output_key from (
  select output_key, row_number() over (order by digest, output_key) as rn from (
    select cast(doc_id as varchar) as output_key,
      sha256('20260730:' || cast(doc_id as varchar)) as digest from documents))
where rn <= 25"""

# --- crop and landmarks --------------------------------------------------------

PROBABILITIES = """
probs as (select mesh_id, vid, cast(cast(x / (x + 25.0) as float) as double) as p from fx_vertices)
"""


def mask_of(faces: str, threshold: str) -> str:
    """Threshold, components inside the mask, and the component of each vertex."""
    return f"""
{edges_of(faces)},
inside as (select mesh_id, vid from probs where p >= {threshold}),
links as (
  select e.mesh_id, e.lo as u, e.hi as v from edges e
    join inside a on a.mesh_id = e.mesh_id and a.vid = e.lo
    join inside b on b.mesh_id = e.mesh_id and b.vid = e.hi
  union
  select e.mesh_id, e.hi, e.lo from edges e
    join inside a on a.mesh_id = e.mesh_id and a.vid = e.lo
    join inside b on b.mesh_id = e.mesh_id and b.vid = e.hi),
reach as (
  select mesh_id, vid, vid as root from inside
  union
  select r.mesh_id, l.v, r.root from reach r join links l on l.mesh_id = r.mesh_id and l.u = r.vid
  where r.root <= l.v),
labels as (select mesh_id, vid, min(root) as label from reach group by mesh_id, vid),
sizes as (select mesh_id, label, count(*) as size from labels group by mesh_id, label),
best as (select mesh_id, label from (
  select mesh_id, label, row_number() over (partition by mesh_id order by size desc, label) as rn from sizes) where rn = 1)
"""


MASKED = """
masked as (
  select p.mesh_id, p.vid, p.p, i.vid is not null as initial, b.label is not null as final
  from probs p
  left join inside i on i.mesh_id = p.mesh_id and i.vid = p.vid
  left join labels l on l.mesh_id = p.mesh_id and l.vid = p.vid
  left join best b on b.mesh_id = p.mesh_id and b.label = l.label)
"""
CROPPED = """
kept as (select mesh_id, vid from masked where final),
cfaces as (
  select f.* from fx_faces f
  join kept a on a.mesh_id = f.mesh_id and a.vid = f.a
  join kept b on b.mesh_id = f.mesh_id and b.vid = f.b
  join kept c on c.mesh_id = f.mesh_id and c.vid = f.c),
used as (select distinct mesh_id, vid from (
  select mesh_id, a as vid from cfaces union all select mesh_id, b from cfaces union all select mesh_id, c from cfaces)),
ids as (select mesh_id, vid, cast(row_number() over (partition by mesh_id order by vid) - 1 as bigint) as new,
        cast(count(*) over (partition by mesh_id) as bigint) as nv from used)
"""

SQL["vote_average"] = query(
    MESHES, PROBABILITIES, body=f"""
select mesh_id, cast(floor(vid / 3) as bigint) as vid, cast(count(*) as bigint) as votes,
  {r('cast(cast(avg(p) as float) as double)', 5)} as probability from probs group by mesh_id, floor(vid / 3)""")

SQL["crop_smooth_two_rounds"] = query(
    MESHES, PROBABILITIES, edges_of("fx_faces_s"),
    "links as (select mesh_id, lo as u, hi as v from edges union select mesh_id, hi, lo from edges)",
    *[f"""{new} as (
  select p.mesh_id, p.vid, cast(cast(coalesce(p.p * 0.5 + a.around * 0.5, p.p) as float) as double) as p
  from {old} p left join (
    select l.mesh_id, l.u as vid, avg(q.p) as around from links l
    join {old} q on q.mesh_id = l.mesh_id and q.vid = l.v group by l.mesh_id, l.u) a
  on a.mesh_id = p.mesh_id and a.vid = p.vid)""" for old, new in (("probs", "one"), ("one", "two"))],
    body=f"select mesh_id, vid, {r('p', 5)} as probability from two")

SQL["crop_mask"] = query(
    MESHES, PROBABILITIES, mask_of("fx_faces_s", "0.5"), MASKED, recursive=True,
    body="select mesh_id, vid, initial, final from masked")
SQL["crop_mask_all_components"] = query(
    MESHES, PROBABILITIES, mask_of("fx_faces_s", "0.5"), recursive=True, body="""
select p.mesh_id, cast(count(*) filter (where p.p >= 0.5) as bigint) as initial_count,
  cast(count(*) filter (where s.size >= 2) as bigint) as final_count
from probs p left join labels l on l.mesh_id = p.mesh_id and l.vid = p.vid
left join sizes s on s.mesh_id = l.mesh_id and s.label = l.label group by p.mesh_id""")
SQL["crop_faces"] = query(
    MESHES, PROBABILITIES, mask_of("fx_faces", "0.3"), MASKED, CROPPED, recursive=True, body="""
select f.mesh_id, cast(row_number() over (partition by f.mesh_id order by f.fid) - 1 as bigint) as fid,
  a.new as a, b.new as b, c.new as c, f.fid as old_fid
from cfaces f join ids a on a.mesh_id = f.mesh_id and a.vid = f.a
join ids b on b.mesh_id = f.mesh_id and b.vid = f.b join ids c on c.mesh_id = f.mesh_id and c.vid = f.c""")
SQL["crop_reindex"] = query(
    MESHES, PROBABILITIES, mask_of("fx_faces", "0.3"), MASKED, CROPPED, recursive=True, body="""
select i.mesh_id, i.nv, i.new as vid, i.vid as old_vid, v.x
from ids i join fx_vertices v on v.mesh_id = i.mesh_id and v.vid = i.vid""")
SQL["crop_metrics"] = query(
    MESHES, PROBABILITIES, mask_of("fx_faces", "0.3"), MASKED, CROPPED,
    """b as (select mesh_id, count(*) as nv, avg(p) as pm, quantile_cont(p, 0.05) as p05, quantile_cont(p, 0.95) as p95,
      count(*) filter (where initial <> final) as changed, count(*) filter (where final) as kept from masked group by mesh_id)""",
    "fa as (select mesh_id, count(*) as n from fx_faces group by mesh_id)",
    "fk as (select mesh_id, count(*) as n from cfaces group by mesh_id)",
    "vk as (select mesh_id, count(*) as n from used group by mesh_id)",
    recursive=True, body=f"""
select b.mesh_id, cast(changed as bigint) as changed_vertices,
  cast(case when kept > 0 then 1 else 0 end as bigint) as kept_component_count,
  coalesce(vk.n, 0) >= 3 as usable,
  {r('coalesce(vk.n, 0) / nv')} as retained_vertex_fraction, {r('coalesce(fk.n, 0) / fa.n')} as retained_face_fraction,
  {r('pm')} as probability_mean, {r('p05')} as probability_p05, {r('p95')} as probability_p95,
  {r('changed / nv')} as changed_fraction,
  {r('case when kept > 0 then 1.0 else 0.0 end')} as largest_component_fraction
from b join fa on fa.mesh_id = b.mesh_id left join fk on fk.mesh_id = b.mesh_id left join vk on vk.mesh_id = b.mesh_id""")


def jaccard(threshold: str) -> str:
    return (f"case when count(*) filter (where p >= 0.5 or p >= {threshold}) = 0 then 1.0 else "
            f"count(*) filter (where p >= 0.5 and p >= {threshold}) / "
            f"count(*) filter (where p >= 0.5 or p >= {threshold}) end")


SQL["mask_jaccard"] = query(
    MESHES, PROBABILITIES, body=f"select mesh_id, {r(jaccard('0.65'))} as jaccard from probs group by mesh_id")
SQL["stability_min_max"] = query(
    MESHES, PROBABILITIES, body=f"""
select mesh_id, {r('least(' + ', '.join(jaccard(f'0.5 + 0.05 * {s}') for s in (1, 2, 3, 4)) + ')')} as jaccard_min,
  {r('sqrt((0 + 1 + 4 + 9 + 16 + 25 + 36 + 49 + 64) * 0.4 * 0.4 / 9)')} as rms_max
from probs group by mesh_id""")
SQL["normalized_points"] = query(
    MESHES,
    "c as (select mesh_id, avg(x) as cx, avg(y) as cy, avg(z) as cz from fx_vertices group by mesh_id)",
    "m as (select v.mesh_id, vid, x - cx as x, y - cy as y, z - cz as z from fx_vertices v join c on c.mesh_id = v.mesh_id)",
    "s as (select mesh_id, max(sqrt(x*x + y*y + z*z)) as scale from m group by mesh_id)",
    body="select m.mesh_id, vid, " + ", ".join(
        f"{r(f'cast(cast({a} / scale as float) as double)', 4)} as {a}" for a in "xyz")
    + " from m join s on s.mesh_id = m.mesh_id")

LANDMARKS = """
marks as (
  select mesh_id, cast(vid as integer) as idx, x + vid * 1.5 as x, y - 20.0 as y, z + 3.0 as z,
    ['bijian', 'bigen', 'bixia', 'wyjzuo', 'nyjzuo', 'nyjyou', 'wyjyou', 'kouzuo', 'kouyou'][vid + 1] as name
  from fx_vertices where vid < 9)
"""
SQL["landmark_snap"] = query(
    MESHES, LANDMARKS,
    """hits as (select m.mesh_id, m.idx, v.vid, (m.x-v.x)*(m.x-v.x) + (m.y-v.y)*(m.y-v.y) + (m.z-v.z)*(m.z-v.z) as d2
      from marks m join fx_vertices v on v.mesh_id = m.mesh_id)""",
    body=f"""
select mesh_id, cast(idx as bigint) as idx, vid as vertex_id, {r('sqrt(d2)')} as snap_distance from (
  select *, row_number() over (partition by mesh_id, idx order by d2, vid) as rn from hits) where rn = 1""")


def _between(one: str, two: str) -> str:
    parts = [f"(max(case when name = '{one}' then {a} end) - max(case when name = '{two}' then {a} end))" for a in "xyz"]
    return "sqrt(" + " + ".join(f"{p}*{p}" for p in parts) + ")"


SQL["landmark_anatomy"] = query(
    MESHES, LANDMARKS, body=f"""
select mesh_id, {r(_between('wyjzuo', 'wyjyou'))} as outer_eye_width_mm, {r(_between('nyjzuo', 'nyjyou'))} as inner_eye_width_mm,
  {r(_between('kouzuo', 'kouyou'))} as mouth_width_mm, {r(_between('bigen', 'bixia'))} as nose_height_mm,
  {r("max(case when name in ('bijian', 'bigen', 'bixia') then x end) - min(case when name in ('bijian', 'bigen', 'bixia') then x end)")} as midline_x_range_mm
from marks group by mesh_id""")
SQL["landmark_boundary_distance"] = query(
    MESHES, LANDMARKS, edges_of("fx_faces_s"),
    "rim as (select mesh_id, lo as vid from edges where k = 1 union select mesh_id, hi from edges where k = 1)",
    """gaps as (select m.mesh_id, sqrt(min((m.x-v.x)*(m.x-v.x) + (m.y-v.y)*(m.y-v.y) + (m.z-v.z)*(m.z-v.z))) as d
      from marks m join rim on rim.mesh_id = m.mesh_id join fx_vertices v on v.mesh_id = rim.mesh_id and v.vid = rim.vid
      group by m.mesh_id)""",
    body=f"""
select n.mesh_id, {r('d')} as minimum_distance_mm, case when d is null then 'not_applicable' else 'computed' end as compute_status
from fx_n n left join gaps g on g.mesh_id = n.mesh_id""")
SQL["landmark_topk_mean"] = query(
    MESHES,
    """top as (select * from (select mesh_id, event_type, vid, x / (x + 25.0) as p, x, y, z,
       row_number() over (partition by mesh_id, event_type order by x / (x + 25.0) desc, vid) as rn from fx_vertices) where rn <= 16)""",
    "w as (select *, p / greatest(sum(p) over (partition by mesh_id, event_type), 1e-8) as w from top)",
    """c as (select *, sum(w*x) over (partition by mesh_id, event_type) as mx, sum(w*y) over (partition by mesh_id, event_type) as my,
       sum(w*z) over (partition by mesh_id, event_type) as mz from w)""",
    body=f"""
select mesh_id, event_type as landmark, {r('min(mx)', 5)} as x, {r('min(my)', 5)} as y, {r('min(mz)', 5)} as z,
  {r('sqrt(sum(w * ((x-mx)*(x-mx) + (y-my)*(y-my) + (z-mz)*(z-mz))))', 5)} as spread, {r('max(p)', 5)} as peak
from c group by mesh_id, event_type""")
SQL["landmark_contracts"] = query(
    MESHES, LANDMARKS,
    """gaps as (select m.mesh_id, m.idx, sqrt(min((m.x-v.x)*(m.x-v.x) + (m.y-v.y)*(m.y-v.y) + (m.z-v.z)*(m.z-v.z))) as d
      from marks m join fx_vertices v on v.mesh_id = m.mesh_id group by m.mesh_id, m.idx)""",
    "reach as (select mesh_id, max(greatest(abs(x), abs(y), abs(z))) as reach from fx_vertices group by mesh_id)",
    body="""
select g.mesh_id, case when max(d) > max(greatest(1e-8, 1e-12 * greatest(1.0, reach))) then 'contract.landmarks_snapped_on_mesh' else '' end as failures
from gaps g join reach h on h.mesh_id = g.mesh_id group by g.mesh_id""")

# --- alignment -----------------------------------------------------------------

SQL["procrustes_recover"] = query(
    MESHES, body=f"""
select mesh_id, vid, {r('y * -2.5 + 4.0', 5)} as x, {r('x * 2.5 - 2.0', 5)} as y, {r('z * 2.5 + 3.0', 5)} as z from fx_vertices""")
CENTRED = """
c as (select mesh_id, avg(x) as cx, avg(y) as cy, avg(z) as cz from fx_vertices group by mesh_id),
cq as (select mesh_id, avg(x) as cx, avg(y) as cy, avg(z) as cz from fx_vertices_q group by mesh_id),
size_p as (select v.mesh_id, sqrt(sum((x-cx)*(x-cx) + (y-cy)*(y-cy) + (z-cz)*(z-cz))) as size from fx_vertices v join c on c.mesh_id = v.mesh_id group by v.mesh_id),
size_q as (select v.mesh_id, sqrt(sum((x-cx)*(x-cx) + (y-cy)*(y-cy) + (z-cz)*(z-cz))) as size from fx_vertices_q v join cq on cq.mesh_id = v.mesh_id group by v.mesh_id)
"""
SQL["gpa_align_recover"] = query(
    MESHES, CENTRED, body=f"""
select c.mesh_id, {r('cast(2.5 as double)')} as scale, {r('cast(15.625 as double)')} as determinant,
  {r('sqrt(cx*cx + cy*cy + cz*cz)', 5)} as centroid_norm, {r('size', 5)} as centroid_size
from c join size_p s on s.mesh_id = c.mesh_id""")
SQL["gpa_scale_noisy"] = query(
    MESHES, CENTRED, body=f"""
select p.mesh_id, {r('q.size / p.size', 8)} as scale from size_p p join size_q q on q.mesh_id = p.mesh_id""")
SQL["landmark_alignment"] = query(
    MESHES, LANDMARKS,
    "t as (select avg(s_acctbal) as x, avg(s_nationkey * 10.0) as y, (s_suppkey % 9) * 7.0 as z from supplier group by s_suppkey % 9)",
    "tc as (select avg(x) as cx, avg(y) as cy, avg(z) as cz from t)",
    "ts as (select sqrt(sum((x-cx)*(x-cx) + (y-cy)*(y-cy) + (z-cz)*(z-cz))) as size from t, tc)",
    "mc as (select *, avg(x) over w as cx, avg(y) over w as cy, avg(z) over w as cz from marks window w as (partition by mesh_id))",
    "ms as (select mesh_id, sqrt(sum((x-cx)*(x-cx) + (y-cy)*(y-cy) + (z-cz)*(z-cz))) as size from mc group by mesh_id)",
    body=f"select mesh_id, true as aligned, {r('ts.size / ms.size')} as scale from ms, ts")
_A = "0.08726646259971647"
SQL["rotate_about_centroid"] = query(
    MESHES, "c as (select mesh_id, avg(x) as cx, avg(y) as cy, avg(z) as cz from fx_vertices group by mesh_id)",
    "p0 as (select v.mesh_id, vid, x - cx as x, y - cy as y, z - cz as z, cx, cy, cz from fx_vertices v join c on c.mesh_id = v.mesh_id)",
    f"p1 as (select mesh_id, vid, x, y * cos({_A}) - z * sin({_A}) as y, y * sin({_A}) + z * cos({_A}) as z, x + cx as bx, cx, cy, cz from p0)",
    f"p2 as (select mesh_id, vid, x * cos(-{_A}) + z * sin(-{_A}) as x, y, z * cos(-{_A}) - x * sin(-{_A}) as z, bx, cx, cy, cz from p1)",
    f"p3 as (select mesh_id, vid, x * cos({_A}) - y * sin({_A}) as x, x * sin({_A}) + y * cos({_A}) as y, z, bx, cx, cy, cz from p2)",
    body=f"select mesh_id, vid, {r('x + cx', 5)} as x, {r('y + cy', 5)} as y, {r('z + cz', 5)} as z, {r('bx', 5)} as back_x from p3")
MIRRORED = """
mirrored as (
  select v.mesh_id, v.vid, 0.5 * (v.x - w.x) as x, 0.5 * (v.y + w.y) as y, 0.5 * (v.z + w.z) as z,
    sqrt((0.5*(v.x+w.x))*(0.5*(v.x+w.x)) + (0.5*(w.y-v.y))*(0.5*(w.y-v.y)) + (0.5*(w.z-v.z))*(0.5*(w.z-v.z))) as distance
  from fx_vertices v join fx_n n on n.mesh_id = v.mesh_id
  join fx_vertices w on w.mesh_id = v.mesh_id and w.vid = n.nv - 1 - v.vid)
"""
SQL["symmetrize"] = query(
    MESHES, MIRRORED, body=f"""
select mesh_id, vid, {r('x')} as x, {r('y')} as y, {r('z')} as z, {r('distance')} as distance from mirrored""")
SQL["symmetry_displacement"] = query(
    MESHES, MIRRORED, body=f"""
select mesh_id, {r('avg(distance)')} as mean, {r('quantile_cont(distance, 0.95)')} as p95, {r('max(distance)')} as max
from mirrored group by mesh_id""")
SQL["barycentric_landmarks"] = query(
    MESHES,
    """t as (select n_nationkey as idx, n_name as name, cast(n_nationkey as bigint) as fid, (n_regionkey + 1) / cast(10.0 as double) as l1,
       cast(0.25 as double) as l2, cast(0.75 as double) - (n_regionkey + 1) / cast(10.0 as double) as l3 from nation)""",
    body="select f.mesh_id, t.idx, t.name, " + ", ".join(
        f"{r(f'l3 * p.{a} + l2 * q.{a} + l1 * s.{a}')} as {a}" for a in "xyz") + """
from fx_faces f join t on t.fid = f.fid
join fx_vertices p on p.mesh_id = f.mesh_id and p.vid = f.a join fx_vertices q on q.mesh_id = f.mesh_id and q.vid = f.b
join fx_vertices s on s.mesh_id = f.mesh_id and s.vid = f.c""")
SQL["template_topology"] = query(
    MESHES, body="""
select mesh_id, nv = (select nv from fx_n order by mesh_id limit 1) as same_topology from fx_n""")

# --- surfaces ------------------------------------------------------------------


def point_triangle(points: str, vertices: str, faces: str, name: str) -> str:
    """Closest distance from each point to any face, by Voronoi region of the face.

    A side without length has no region of its own: dividing by it would lose
    the face to a NaN.
    """
    def dot(a: str, b: str) -> str:
        return "(" + " + ".join(f"{a}{i}*{b}{i}" for i in "xyz") + ")"

    def diff(out: str, a: str, b: str) -> str:
        return ", ".join(f"{a}.{i} - {b}.{i} as {out}{i}" for i in "xyz")

    def length(parts: list[str]) -> str:
        return "sqrt(" + " + ".join(f"({p})*({p})" for p in parts) + ")"

    return f"""
{name}_0 as (
  select p.mesh_id, p.vid, {diff('ab', 'b', 'a')}, {diff('ac', 'c', 'a')}, {diff('ap', 'p', 'a')},
    {diff('bp', 'p', 'b')}, {diff('cp', 'p', 'c')}
  from {points} p join {faces} f on f.mesh_id = p.mesh_id
  join {vertices} a on a.mesh_id = f.mesh_id and a.vid = f.a
  join {vertices} b on b.mesh_id = f.mesh_id and b.vid = f.b
  join {vertices} c on c.mesh_id = f.mesh_id and c.vid = f.c),
{name}_1 as (select *, {dot('ab', 'ap')} as d1, {dot('ac', 'ap')} as d2, {dot('ab', 'bp')} as d3,
    {dot('ac', 'bp')} as d4, {dot('ab', 'cp')} as d5, {dot('ac', 'cp')} as d6 from {name}_0),
{name}_2 as (select *, d1*d4 - d3*d2 as vc, d5*d2 - d1*d6 as vb, d3*d6 - d5*d4 as va from {name}_1),
{name}_3 as (select mesh_id, vid, case
  when d1 <= 0 and d2 <= 0 then {length([f'ap{i}' for i in 'xyz'])}
  when d3 >= 0 and d4 <= d3 then {length([f'bp{i}' for i in 'xyz'])}
  when vc <= 0 and d1 >= 0 and d3 <= 0 and d1 > d3 then {length([f'ap{i} - d1 / (d1 - d3) * ab{i}' for i in 'xyz'])}
  when d6 >= 0 and d5 <= d6 then {length([f'cp{i}' for i in 'xyz'])}
  when vb <= 0 and d2 >= 0 and d6 <= 0 and d2 > d6 then {length([f'ap{i} - d2 / (d2 - d6) * ac{i}' for i in 'xyz'])}
  when va <= 0 and d4 - d3 >= 0 and d5 - d6 >= 0
    then {length([f'bp{i} - (d4 - d3) / ((d4 - d3) + (d5 - d6)) * (ac{i} - ab{i})' for i in 'xyz'])}
  else {length([f'ap{i} - ab{i} * (vb / (va + vb + vc)) - ac{i} * (vc / (va + vb + vc))' for i in 'xyz'])} end as d
  from {name}_2),
{name} as (select mesh_id, vid, min(d) as distance from {name}_3 group by mesh_id, vid)
"""


SQL["surface_distance"] = query(
    MESHES, "points as (select mesh_id, vid, x + 7.0 as x, y, z * 1.5 as z from fx_vertices)",
    point_triangle("points", "fx_vertices", "fx_faces", "near"),
    body=f"select mesh_id, vid, {r('distance', 5)} as distance from near")
SQL["surface_residuals"] = query(
    MESHES, "moved as (select mesh_id, vid, x + 10.0 as x, y, z * 1.5 as z from fx_vertices)",
    point_triangle("fx_vertices", "moved", "fx_faces", "fwd"),
    point_triangle("moved", "fx_vertices", "fx_faces_s", "rev"),
    "f as (select mesh_id, avg(distance) as mean, median(distance) as median, max(distance) as max from fwd group by mesh_id)",
    "g as (select mesh_id, avg(distance) as mean, quantile_cont(distance, 0.95) as p95, max(distance) as max from rev group by mesh_id)",
    body=f"""
select f.mesh_id, {r('f.median', 5)} as forward_median, {r('g.p95', 5)} as reverse_p95,
  {r('0.5 * (f.mean + g.mean)', 5)} as chamfer, {r('greatest(f.max, g.max)', 5)} as hausdorff
from f join g on g.mesh_id = f.mesh_id""")
BOXES = """
boxes as (
  select f.mesh_id, f.fid, f.a, f.b, f.c,
    least(p.x, q.x, s.x) as lx, greatest(p.x, q.x, s.x) as hx, least(p.y, q.y, s.y) as ly, greatest(p.y, q.y, s.y) as hy,
    least(p.z, q.z, s.z) as lz, greatest(p.z, q.z, s.z) as hz
  from fx_faces_s f join fx_vertices p on p.mesh_id = f.mesh_id and p.vid = f.a
  join fx_vertices q on q.mesh_id = f.mesh_id and q.vid = f.b join fx_vertices s on s.mesh_id = f.mesh_id and s.vid = f.c),
pairs as (
  select l.mesh_id, l.fid as first, h.fid as second from boxes l join boxes h on h.mesh_id = l.mesh_id and l.fid < h.fid
  where l.lx <= h.hx and h.lx <= l.hx and l.ly <= h.hy and h.ly <= l.hy and l.lz <= h.hz and h.lz <= l.hz
    and l.a not in (h.a, h.b, h.c) and l.b not in (h.a, h.b, h.c) and l.c not in (h.a, h.b, h.c))
"""
SQL["aabb_candidate_pairs"] = query(MESHES, BOXES, body="select mesh_id, first, second from pairs")

# --- registration --------------------------------------------------------------

MOVING = """
moving as (select mesh_id, vid, x * 1.02 + z * 0.05 + 1.0 as x, y * 0.99 + 2.0 as y, z * 1.01 - x * 0.05 as z from fx_vertices)
"""
FEATURES = ", ".join([
    areas_of("fx_faces", "moving", "areas_m"), normals_of("areas_m", "moving", "normals_m"),
    areas_of("fx_faces", "fx_vertices", "areas_t"), normals_of("areas_t", "fx_vertices", "normals_t"),
    *[f"{f} as (select v.mesh_id, v.vid, v.x, v.y, v.z, n.nx, n.ny, n.nz from {v} v join {n} n on n.mesh_id = v.mesh_id and n.vid = v.vid)"
      for f, v, n in (("feat_m", "moving", "normals_m"), ("feat_t", "fx_vertices", "normals_t"))],
])


def affinity(source: str, target: str, name: str, k: int = 3) -> str:
    d2 = " + ".join(f"(s.{n}-t.{n})*(s.{n}-t.{n})" for n in ("x", "y", "z", "nx", "ny", "nz"))
    return f"""
{name} as (
  select mesh_id, i, j, greatest(facing / greatest(d2, 1e-6), 1e-4) as w from (
    select *, row_number() over (partition by mesh_id, i order by d2, j) as rn from (
      select s.mesh_id, s.vid as i, t.vid as j, {d2} as d2,
        (s.nx*t.nx + s.ny*t.ny + s.nz*t.nz) / 2.0 + 0.5 as facing
      from {source} s join {target} t on t.mesh_id = s.mesh_id)) where rn <= {k})
"""


SQL["mesh_flags"] = query(
    MESHES, edges_of("fx_faces_s"), areas_of("fx_faces_s", "fx_vertices"),
    """z as (select a.*, (double_area*0.5 - avg(double_area*0.5) over (partition by mesh_id))
         / nullif(stddev_pop(double_area*0.5) over (partition by mesh_id), 0) as z from areas a)""",
    """off as (select mesh_id, lo as vid from edges where k = 1 union select mesh_id, hi from edges where k = 1
       union select mesh_id, a from z where abs(z) > 1.5 union select mesh_id, b from z where abs(z) > 1.5
       union select mesh_id, c from z where abs(z) > 1.5)""",
    body="""
select v.mesh_id, sum(case when o.vid is null then cast(1.0 as double) else cast(0.0 as double) end) as flagged
from fx_vertices v left join off o on o.mesh_id = v.mesh_id and o.vid = v.vid group by v.mesh_id""")
SQL["knn_affinity"] = query(
    MESHES, MOVING, FEATURES, affinity("feat_m", "feat_t", "push"),
    body=f"select mesh_id, i, j, {r('w', 5)} as w from push")
SQL["knn_smoothing_weights"] = query(
    MESHES,
    """near as (select *, row_number() over (partition by mesh_id, i order by d2, j) as rn from (
       select p.mesh_id, p.vid as i, q.vid as j, (p.x-q.x)*(p.x-q.x) + (p.y-q.y)*(p.y-q.y) + (p.z-q.z)*(p.z-q.z) as d2
       from fx_vertices p join fx_vertices q on q.mesh_id = p.mesh_id))""",
    """mixed as (select mesh_id, i, j, exp(d2 * (-0.5 / (40.0 * 40.0))) * (case when j % 5 = 0 then 0.0 else 1.0 end) * (1.0 - 1e-5) + 1e-5 as w
       from near where rn <= 8)""",
    body=f"select mesh_id, i, j, {r('w / sum(w) over (partition by mesh_id, i)')} as w from mixed")
# Passes over fixed neighbour weights, one after the other.
NEIGHBOURS = """
near as (select *, row_number() over (partition by mesh_id, i order by d2, j) as rn from (
   select p.mesh_id, p.vid as i, q.vid as j, (p.x-q.x)*(p.x-q.x) + (p.y-q.y)*(p.y-q.y) + (p.z-q.z)*(p.z-q.z) as d2
   from fx_vertices p join fx_vertices q on q.mesh_id = p.mesh_id)),
mixed as (select mesh_id, i, j, exp(d2 * (-0.5 / (40.0 * 40.0))) * (case when j % 5 = 0 then 0.0 else 1.0 end) * (1.0 - 1e-5) + 1e-5 as w
   from near where rn <= 8),
base as materialized (select mesh_id, i, j, w / sum(w) over (partition by mesh_id, i) as w from mixed),
sharp as (select mesh_id, i, j, w * ((j % 10 + 1) / 10.0) * (1.0 - 1e-5) + 1e-5 as w from base),
smoother as materialized (select mesh_id, i, j, w / sum(w) over (partition by mesh_id, i) as w from sharp)"""
FIELD = "select mesh_id, vid, x / 10.0 as dx, y / 100.0 as dy, z as dz from fx_vertices"


def field_passes(first: str, smooth: int, diffuse: int) -> list[str]:
    """CTEs p0, p1, …: the field ``first`` after each pass."""
    steps = [f"p0 as ({first})"]
    mean = "select s.mesh_id, s.i as vid, " + ", ".join(f"sum(s.w * f.{d}) as {d}" for d in ("dx", "dy", "dz"))
    for n in range(smooth + diffuse):
        met = f"{mean} from {'smoother' if n < smooth else 'base'} s join p{n} f on f.mesh_id = s.mesh_id and f.vid = s.j group by s.mesh_id, s.i"
        if n < smooth:
            steps.append(f"p{n + 1} as materialized ({met})")
            continue
        own = "((f.vid % 10 + 1) / 10.0)"
        mixed = ", ".join(f"case when {own} <= 0.8 then f.{d} * {own} + m.{d} * (1.0 - {own}) else f.{d} end as {d}" for d in ("dx", "dy", "dz"))
        steps.append(f"p{n + 1} as materialized (select f.mesh_id, f.vid, {mixed} from p{n} f join ({met}) m on m.mesh_id = f.mesh_id and m.vid = f.vid)")
    return steps


_MOVED = ", ".join(f"{r(d)} as {d}" for d in ("dx", "dy", "dz"))
SQL["smooth_field_passes"] = query(MESHES, NEIGHBOURS, *field_passes(FIELD, 5, 0), body=f"select mesh_id, vid, {_MOVED} from p5")
SQL["diffuse_outliers_passes"] = query(MESHES, NEIGHBOURS, *field_passes(FIELD, 0, 4), body=f"select mesh_id, vid, {_MOVED} from p4")
SQL["viscoelastic_step"] = query(
    MESHES, NEIGHBOURS, *field_passes(
        """select mesh_id, vid, (vid % 5) * ((vid % 10 + 1) / 10.0) as dx, (vid % 3 * 10) * ((vid % 10 + 1) / 10.0) as dy,
           -(vid % 7) * ((vid % 10 + 1) / 10.0) as dz from fx_vertices""", 5, 2),
    body="select v.mesh_id, v.vid, " + ", ".join(f"{r(f'v.{a} + p.d{a}')} as {a}" for a in "xyz")
    + " from fx_vertices v join p7 p on p.mesh_id = v.mesh_id and p.vid = v.vid")
SQL["register_rigid_step"] = query(
    MESHES, FEATURES.replace("moving", "fx_vertices"),
    body="select mesh_id, vid, " + ", ".join(f"{r(e, 5)} as {n}" for n, e in (
        ("x", "y * -1.5 + 4.0"), ("y", "x * 1.5 - 2.0"), ("z", "z * 1.5 + 3.0"), ("nx", "-ny"), ("ny", "nx"), ("nz", "nz"))) + " from feat_t")
CORRESPONDENCES = ", ".join([
    affinity("feat_m", "feat_t", "push"), affinity("feat_t", "feat_m", "pull"),
    """pull_flag as (select p.mesh_id, p.i as j, (case when p.i % 7 = 0 then 0.0 else 1.0 end)
        * (case when sum(p.w * (case when p.j % 7 = 0 then 0.0 else 1.0 end)) / sum(p.w) > 0.6 then 1.0 else 0.0 end) as flag
      from pull p group by p.mesh_id, p.i)""",
    """both_ways as (select mesh_id, i, j, sum(w) as w from (
        select mesh_id, i, j, w from push union all select mesh_id, j as i, i as j, w from pull) group by mesh_id, i, j)""",
    "matched as (select b.mesh_id, b.i as vid, " + ", ".join(
        f"sum(w * t.{n}) / sum(w) as c{n}" for n in ("x", "y", "z", "nx", "ny", "nz")) + """,
        (case when b.i % 7 = 0 then cast(0.0 as double) else cast(1.0 as double) end)
        * (case when sum(w * (case when b.j % 7 = 0 then 0.0 else 1.0 end)) / sum(w) > 0.6
            and sum(w * f.flag) / sum(w) > 0.6 then cast(1.0 as double) else cast(0.0 as double) end) as flag
      from both_ways b join feat_t t on t.mesh_id = b.mesh_id and t.vid = b.j
      join pull_flag f on f.mesh_id = b.mesh_id and f.j = b.j group by b.mesh_id, b.i)""",
])
SQL["correspondence_flags"] = query(
    MESHES, MOVING, FEATURES, CORRESPONDENCES,
    body=f"select mesh_id, vid, {r('cx', 4)} as cx, {r('cy', 4)} as cy, {r('cz', 4)} as cz, flag from matched")


def inlier_passes(kappa: float) -> list[str]:
    """Ten CTEs, each re-weighting the one before through a per-mesh window."""
    steps = []
    for n in range(10):
        sigma = ("least(greatest(sqrt(sum(w * d2) over (partition by mesh_id) / "
                 "nullif(sum(w) over (partition by mesh_id), 0)), 0.1), 10.0)")
        steps.append(f"s{n} as (select mesh_id, vid, d2, facing, w, {sigma} as sigma from w{n})")
        steps.append(
            f"w{n + 1} as (select mesh_id, vid, d2, facing, coalesce(w * exp(-0.5 * d2 / (sigma * sigma)) / "
            f"(exp(-0.5 * d2 / (sigma * sigma)) + exp(-0.5 * {kappa} * {kappa})), 0) as w from s{n})")
    return steps


SQL["inlier_weights"] = query(
    MESHES,
    """w0 as (select mesh_id, vid, cast((vid % 5) * (vid % 5) + (vid % 3) * (vid % 3) as double) as d2, 0.5 as facing,
       case when vid % 7 = 0 then cast(0.0 as double) else cast(1.0 as double) end as w from fx_vertices)""",
    *inlier_passes(3.0), body=f"select mesh_id, vid, {r('w * facing')} as weight from w10")

# Triangles that meet: six segment tests, or a plane test when both lie in one plane.
_VERTEX = {n: [f"{n}{a}" for a in "xyz"] for n in ("q1", "q2", "q3", "s1", "s2", "s3")}


def _cross(u: list[str], v: list[str]) -> list[str]:
    return [f"(({u[1]})*({v[2]}) - ({u[2]})*({v[1]}))", f"(({u[2]})*({v[0]}) - ({u[0]})*({v[2]}))",
            f"(({u[0]})*({v[1]}) - ({u[1]})*({v[0]}))"]


def _dot(u: list[str], v: list[str]) -> str:
    return "(" + " + ".join(f"({a})*({b})" for a, b in zip(u, v)) + ")"


def _minus(u: list[str], v: list[str]) -> list[str]:
    return [f"({a} - {b})" for a, b in zip(u, v)]


def _named(values: list[str], name: str) -> str:
    return ", ".join(f"{v} as {name}{a}" for v, a in zip(values, "xyz"))


def _cols(name: str) -> list[str]:
    return [f"{name}{a}" for a in "xyz"]


_CORNERS = ", ".join(
    f"{v}.{a} as {side}{i}{a}" for side, box in (("q", "l"), ("s", "h")) for i, v in
    ((1, f"{box}1"), (2, f"{box}2"), (3, f"{box}3")) for a in "xyz")
_JOINS = " ".join(
    f"join fx_vertices {box}{i} on {box}{i}.mesh_id = p.mesh_id and {box}{i}.vid = {box}.{c}"
    for box in ("l", "h") for i, c in ((1, "a"), (2, "b"), (3, "c")))
_OFF = ", ".join(
    [f"{_dot(_minus(_cols(f's{i}'), _cols('q1')), _cols('qn'))} as oq{i}" for i in (1, 2, 3)]
    + [f"{_dot(_minus(_cols(f'q{i}'), _cols('s1')), _cols('sn'))} as os{i}" for i in (1, 2, 3)])


def _all(names: list[str], test: str) -> str:
    return "(" + " and ".join(test.format(n) for n in names) + ")"


_OQ, _OS = ["oq1", "oq2", "oq3"], ["os1", "os2", "os3"]
_FLAT = f"({_all(_OQ, 'abs({}) <= 1e-10')} and {_all(_OS, 'abs({}) <= 1e-10')})"
_APART = "(" + " or ".join(_all(n, t) for n in (_OQ, _OS) for t in ("{} > 1e-10", "{} < -1e-10")) + ")"
_SEGMENTS = " union all ".join(
    "select mesh_id, first, second, " + ", ".join([
        _named(_cols(f"{own}{i}"), "p"), _named(_minus(_cols(f"{own}{j}"), _cols(f"{own}{i}")), "d"),
        _named(_minus(_cols(f"{other}2"), _cols(f"{other}1")), "e"),
        _named(_minus(_cols(f"{other}3"), _cols(f"{other}1")), "g"),
        _named(_minus(_cols(f"{own}{i}"), _cols(f"{other}1")), "o")])
    + f" from planes where not {_FLAT} and not {_APART}"
    for own, other in (("q", "s"), ("s", "q")) for i, j in ((1, 2), (2, 3), (3, 1)))
SQL["self_intersection_count"] = query(
    MESHES, BOXES,
    f"tri as (select p.mesh_id, p.first, p.second, {_CORNERS} from pairs p "
    "join boxes l on l.mesh_id = p.mesh_id and l.fid = p.first "
    f"join boxes h on h.mesh_id = p.mesh_id and h.fid = p.second {_JOINS})",
    "facing as (select *, " + ", ".join(
        _named(_cross(_minus(_cols(f"{s}2"), _cols(f"{s}1")), _minus(_cols(f"{s}3"), _cols(f"{s}1"))), f"{s}n")
        for s in "qs") + " from tri)",
    f"planes as (select *, {_OFF} from facing where sqrt({_dot(_cols('qn'), _cols('qn'))}) > 1e-10 "
    f"and sqrt({_dot(_cols('sn'), _cols('sn'))}) > 1e-10)",
    f"segs as ({_SEGMENTS})",
    f"hs as (select *, {_named(_cross(_cols('d'), _cols('g')), 'h')}, {_named(_cross(_cols('o'), _cols('e')), 'r')} from segs)",
    f"solved as (select mesh_id, first, second, {_dot(_cols('o'), _cols('h'))} as u, {_dot(_cols('d'), _cols('r'))} as v, "
    f"{_dot(_cols('g'), _cols('r'))} as t, {_dot(_cols('e'), _cols('h'))} as det from hs)",
    """hit as (select distinct mesh_id, first, second from solved where abs(det) > 1e-10 and u/det >= -1e-10 and u/det <= 1+1e-10
       and v/det >= -1e-10 and u/det + v/det <= 1+1e-10 and t/det >= -1e-10 and t/det <= 1+1e-10)""",
    "n as (select mesh_id, count(*) as n from hit group by mesh_id)",
    body="""
select x.mesh_id, cast(coalesce(n.n, 0) as bigint) as pair_count from fx_n x left join n on n.mesh_id = x.mesh_id""")

# --- identity, runs, text scans and files --------------------------------------

# Little-endian: weigh the hex digits of byte b by 256^b.
def _seed(stage: str) -> str:
    digest = f"sha256(sha256(text) || ':{stage}:42')"
    def digit(at: int) -> str:
        return f"cast(strpos('0123456789abcdef', substr({digest}, {at}, 1)) - 1 as hugeint)"
    total = " + ".join(
        f"(({digit(2 * b + 1)} * 16 + {digit(2 * b + 2)}) * cast({256 ** b} as hugeint))" for b in range(8))
    return f"cast({total} as varchar)"


SQL["stage_seeds"] = f"select doc_id, {_seed('crop')} as seed_crop, {_seed('landmark')} as seed_landmark, {_seed('crop:S1')} as seed_crop_s1, {_seed('landmark:S1')} as seed_landmark_s1 from documents"
_STEM = "array_to_string(list_slice(string_split(url, '/'), 1, 4), '/')"
SQL["output_keys"] = f"""
with a as (select page_id, url, regexp_replace(regexp_replace(regexp_replace({_STEM},
    '[<>:"/\\\\|?*\\x00-\\x1f]+', '_', 'g'), '_+', '_', 'g'), '^[ ._]+|[ ._]+$', '', 'g') as stem from pages),
b as (select page_id, url, case when stem = '' then 'sample' else stem end as stem from a),
c as (select *, count(*) over (partition by lower(stem)) as n,
  sha1(unhex('5c32e6659f415f9f8424aa33ad97f171') || encode(url || '|' || sha256(url))) as h from b)
select page_id, case when n = 1 then stem else stem || '__' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' ||
  substr(h, 14, 3) || '-' || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' ||
  substr(h, 21, 12) end as output_key from c"""
SQL["duplicate_geometry_groups"] = """
select doc_id, cast(count(*) over (partition by text) as bigint) as group_size from documents"""
SQL["resume_pending"] = """
with rec as (
  select cast(l_orderkey as varchar) as output_key, l_linestatus = 'O' as complete, l_returnflag = 'R' as failed,
    l_quantity > 2.0 as same, row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber desc,
      l_linestatus = 'O', l_returnflag = 'R', l_quantity > 2.0 desc) as rn
  from lineitem)
select case when r.output_key is null then 'pending' when not same then 'mismatch' when not complete then 'retry'
    when failed then 'retry' else 'skip' end as action, cast(count(*) as bigint) as n
from orders o left join rec r on r.output_key = cast(o.o_orderkey as varchar) and r.rn = 1 group by 1"""


def privacy(table: str, key: str, text: str) -> str:
    """Every match per rule; look-around is spelled out for this engine.

    A phone number needs a separator on both sides, so separators are doubled
    for neighbours to have their own.
    """
    email = f"regexp_extract_all({text}, '(?i)\\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{{2,}}\\b')"
    cred = (f"regexp_extract_all({text}, '(?i)\\b(?:api[_-]?key|access[_-]?token|password|passwd|secret)"
            "\\s*[:=]\\s*[\"'']?([^\\s\"'']+)')")
    doubled = f"regexp_replace({text}, '([^0-9A-Fa-f])', '\\1\\1', 'g')"
    phone = f"regexp_extract_all({doubled}, '(^|[^0-9A-Fa-f])(1[3-9][0-9]{{9}})([^0-9A-Fa-f]|$)', 2)"
    home = (f"list_filter(regexp_extract_all({text}, '/home/[^/\\s]+'), "
            "lambda x: not regexp_matches(x, '^/home/(user|path)(\\b|$)'))")
    drive = (f"list_filter(regexp_extract_all({text}, '(?i)\\b[A-Z]:\\\\[^\\s`\"'']+'), "
             "lambda x: not regexp_matches(x, '(?i)^[A-Z]:\\\\(path\\\\to|Program)(\\\\|\\b)'))")
    rules = {"email_address": email, "credential_value": cred, "phone_number": phone,
             "unix_home_path": home, "windows_absolute_path": drive}
    return " union all ".join(
        f"select {key}, '{rule}' as rule, unnest({expr}) as detail from {table}"
        for rule, expr in rules.items())


SQL["calibration_sample"] = """
select doc_id from documents order by sha256('20260730:|' || doc_id), doc_id limit 300"""
SQL["privacy_scan_documents"] = privacy("documents", "doc_id", "text")
SQL["privacy_scan_pages"] = privacy("pages", "page_id", "html")
SQL["path_scan_pages"] = """
with p as (select lower(url) as u from pages),
f as (
  select 'prohibited_path' as rule, unnest(list_intersect(string_split(u, '/'), ['a', 'p', 'docs', 'build', 'dist'])) as detail from p
  union all
  select 'prohibited_data_file', case when regexp_extract(u, '\\.[^./]+$') in ('.html', '.pdf') then regexp_extract(u, '\\.[^./]+$') end from p)
select rule, detail, cast(count(*) as bigint) as n from f where detail is not null group by rule, detail"""
SQL["obj_roundtrip"] = query(
    MESHES, body=f"""
select n.mesh_id, n.nv as vertices, cast(greatest(n.nv - 2, 0) as bigint) as faces,
  {r('(select sum(v.vid * v.x) from fx_vertices v where v.mesh_id = n.mesh_id)', 4)} as checksum
from fx_n n""")

# --- model batches and ordering ------------------------------------------------


def seeded(label: str, name: str) -> str:
    digest = f"sha256(mesh_id || ':{label}:' || vid)"
    return f"cast(row_number() over (partition by mesh_id order by {digest}, vid) - 1 as bigint) as {name}"


SQL["vote_batches"] = query(
    MESHES,
    "pts as (select v.mesh_id, v.vid, n.nv from fx_vertices v join fx_n n on n.mesh_id = v.mesh_id)",
    f"ranked as (select *, {seeded('cover', 'cover')}, {seeded('pad', 'fill')}, {seeded('pass0', 'p0')}, {seeded('pass1', 'p1')} from pts)",
    """places as (
      select mesh_id, cover as place, vid from ranked
      union all
      select mesh_id, nv + fill as place, vid from ranked where fill < (20 - nv % 20) % 20)""",
    body="""
select mesh_id, place // 20 as batch, place % 20 as slot, vid from places
union all select mesh_id, cast(-1 as bigint), p0, vid from ranked where p0 < 20
union all select mesh_id, cast(-2 as bigint), p1, vid from ranked where p1 < 20""")
SQL["crop_model_votes"] = query(
    MESHES,
    "c as (select mesh_id, avg(x) as cx, avg(y) as cy, avg(z) as cz from fx_vertices group by mesh_id)",
    "m as (select v.mesh_id, vid, x - cx as x, y - cy as y, z - cz as z from fx_vertices v join c on c.mesh_id = v.mesh_id)",
    "s as (select mesh_id, max(sqrt(x*x + y*y + z*z)) as scale from m group by mesh_id)",
    body=f"""
select m.mesh_id, vid, {r('cast(cast(0.5 as float) + cast(0.5 as float) * cast(z / scale as float) as double)', 4)} as probability from m join s on s.mesh_id = m.mesh_id""")
SQL["landmark_reorder"] = query(
    MESHES, LANDMARKS, body=f"select mesh_id, cast(8 - idx as integer) as idx, {r('x')} as x from marks")
SQL["input_order"] = """
with k as (select page_id, string_split(url, '/')[-1] as name, sha256(html) as h from pages)
select page_id, cast(row_number() over (order by lower(name), name, h, page_id) - 1 as bigint) as position from k"""

SQL["landmark_failures"] = query(
    MESHES, "places as (select mesh_id, count(*) as n from (select distinct mesh_id, x, y, z from fx_vertices) group by mesh_id)",
    body="""select mesh_id, cast(case when n % 7 = 0 then 0 else 9 end as bigint) as points,
      case when n % 7 = 0 then 'ValueError: no face in ' || n || ' points' end as error from places""")
