"""The SQL each registered query must agree with."""

from __future__ import annotations

from cueloom.constants import STRICT_PUNCTUATION

_MEDIA_EXT = (
    "case page_id % 5 when 0 then '.mp4' when 1 then '.mov' when 2 then '.wav' when 3 then '.mp3' else '.MP4' end"
)
_TEXT_EXT = "case page_id % 3 when 0 then '.srt' when 1 then '.vtt' else '.txt' end"
_HOST = "regexp_extract(url, '//([^/]+)', 1)"


def _language(column: str) -> str:
    return f"case {column} % 4 when 0 then 'en' when 1 then 'fi' when 2 then 'sv' else 'da' end"


MANIFEST = f"""manifest as (
  select page_id as manifest_id,
    case when page_id % 17 = 0 then null
      else concat(case when page_id % 7 = 0 then '' else 'clip_' end, page_id, {_MEDIA_EXT}) end as media_file,
    concat('clip_', page_id, {_TEXT_EXT}) as transcript_file,
    {_language("page_id")} as "language"
  from pages)"""

LISTING = f"""media_objects as (
  select concat({_HOST}, '/clip_', page_id, {_MEDIA_EXT}, case when page_id % 11 = 0 then '.part' else '' end) as path,
    length(url)::bigint as length from pages),
transcript_objects as (
  select concat({_HOST}, '/clip_', page_id, {_TEXT_EXT}) as path, length(url)::bigint as length from pages),
listing as (select * from media_objects union all select * from transcript_objects)"""

FETCHED = f"""fetched_audio as (select concat('clip_', page_id, '.wav') as name from pages where url like '%/en/%'),
fetched_text as (select concat('clip_', page_id, {_TEXT_EXT}) as name from pages where url like '%/en/%')"""

RESOLVED = f"""{MANIFEST}, {LISTING},
resolved as (
  select m.*,
    (select min(path) from listing where ends_with(path, m.media_file)) as media_path,
    (select min(path) from listing where ends_with(path, m.transcript_file)) as transcript_path
  from manifest m)"""

_EXT_RE = r"^(\.*[^./][^/]*)\.[^./]*$"


def _basename(path: str) -> str:
    return f"regexp_extract({path}, '[^/]*$')"


def _stem(path: str) -> str:
    return rf"regexp_replace({path}, '{_EXT_RE}', '\1')"


def _rstem(path: str) -> str:
    return rf"regexp_replace({path}, '\.[^.]*$', '')"


def _audio_name(path: str) -> str:
    return f"{_rstem(_basename(path))} || '.wav'"


def _kind(path: str) -> str:
    return f"""case when regexp_matches({path}, '\\.(mp4|avi|mov|m4v)$') then 'video'
      when ends_with({path}, '.wav') then 'audio_wav' else 'other' end"""


def _strict(text: str) -> str:
    quoted = STRICT_PUNCTUATION.replace("'", "''")
    return f"translate(lower({text}), '{quoted}', '')"


def _basic(text: str) -> str:
    out = rf"regexp_replace(lower({text}), '[<\[][^>\]]*[>\]]', '', 'g')"
    out = rf"regexp_replace({out}, '\([^)]+\)', '', 'g')"
    out = rf"lower(regexp_replace({out}, '[\pM\pS\pP]', ' ', 'g'))"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


def _words(text: str) -> str:
    return rf"list_filter(string_split_regex(lower({text}), '\s+'), lambda w: w <> '')"


PAIRS = f"""turn_words as (
  select *, string_split_regex(text, '[ \n]') as w from conversations),
pairs as (
  select conv_id, turn, {_language("conv_id")} as "language",
    concat('audio/conv_', conv_id, '_', turn, '.wav') as audio_path, role,
    array_to_string(w, ' ') as reference,
    case when (conv_id + turn) % 13 = 0 then '' else array_to_string(flatten(list_transform(w, lambda x, i:
      case when (i - 1) % 7 = 3 then []::varchar[] when (i - 1) % 11 = 5 then ['xx']
           when (i - 1) % 13 = 8 then [x, x] else [x] end)), ' ') end as hypothesis
  from turn_words)"""

STRICT_PAIRS = f"""{PAIRS},
strict_pairs as (
  select * from (select * replace ({_strict("reference")} as reference, {_strict("hypothesis")} as hypothesis)
                 from pairs)
  where trim(reference) <> '' and trim(hypothesis) <> '')"""


def _aligned(source: str, reference: str = "reference", hypothesis: str = "hypothesis") -> str:
    """Minimum edits, then fewest deletions, by anti-diagonals over whole texts."""
    return f"""tokens as (
  select conv_id, turn, {_words(reference)} as r, {_words(hypothesis)} as h from {source}),
sized as (select *, len(r) as n, len(h) as m from tokens),
diagonals as (
  select conv_id, turn, n, m, 0 as d, r, h,
    list_transform(range(n + 1), lambda i: case when i = 0 then 0 else 1000000000000000 end) as here,
    list_transform(range(n + 1), lambda i: 1000000000000000) as before
  from sized
  union all
  select conv_id, turn, n, m, d + 1, r, h,
    list_transform(range(n + 1), lambda i:
      case when d + 1 - i < 0 or d + 1 - i > m then 1000000000000000 else least(
        case when i > 0 then here[i] + 1048577 else 1000000000000000 end,
        case when d + 1 - i > 0 then here[i + 1] + 1048576 else 1000000000000000 end,
        case when i > 0 and d + 1 - i > 0
             then before[i] + case when r[i] = h[d + 1 - i] then 0 else 1048576 end
             else 1000000000000000 end) end),
    here
  from diagonals where d < n + m),
costs as (
  select conv_id, turn, n, m, here[n + 1] // 1048576 as edits, here[n + 1] % 1048576 as deletions
  from diagonals where d = n + m),
counts as (
  select conv_id, turn, n::bigint as ref_words, edits::bigint as edits,
    (edits - deletions - (deletions - n + m))::bigint as substitutions, deletions::bigint as deletions,
    (deletions - n + m)::bigint as insertions,
    (n - (edits - deletions - (deletions - n + m)) - deletions)::bigint as hits
  from costs)"""


SCORED = f"{STRICT_PAIRS}, {_aligned('strict_pairs')}"
_WER = "round(100::double * sum(edits) / sum(ref_words), 6) as wer"


def _fixed(samples: str) -> str:
    """Samples as text, in millionths."""
    return f"array_to_string(list_transform({samples}, lambda x: round(x::double * 1000000)::bigint), ',')"


CUE_LINES = """lines as (
  select conv_id, turn, role, line, pos - 1 as i, turn * 4000 + conv_id * 37 + (pos - 1) * 2000 as start_ms
  from (select conv_id, turn, role, unnest(string_split(text, chr(10))) as line,
          generate_subscripts(string_split(text, chr(10)), 1) as pos from conversations)),
srt as (
  select conv_id, turn, i + 1 as cue_no, start_ms, start_ms + 1500 as end_ms,
    '<i>' || role || '</i>' || chr(10) || line as text from lines),
vtt as (select conv_id, turn, i + 1 as cue_no, start_ms, start_ms + 1500 as end_ms, line as text from lines),
mixed as (
  select s.* from srt s join conversations c using (conv_id, turn) where c.role = 'user'
  union all select v.* from vtt v join conversations c using (conv_id, turn) where c.role = 'assistant')"""

FRAMES = """frames as (
  select vec_id // 50 as audio_id, vec_id % 50 as frame_no, embedding as samples, vec_id % 2 + 1 as channels, label
  from embeddings),
cues as (
  select vec_id // 50 as audio_id, vec_id % 50 as cue_no, vec_id % 50 * 1100 + 125 as start_ms,
    vec_id % 50 * 1100 + case when vec_id % 16 = 15 then 25 else 2425 end as end_ms
  from embeddings),
signals as (select audio_id, flatten(list(samples order by frame_no)) as signal from frames group by audio_id)"""

_STEREO_DOWN = """list_transform(range(len(samples) // 2), lambda i:
    ((samples[2 * i + 1]::double + samples[2 * i + 2]::double) / 2)::float::double)"""
_MIXED_DOWN = f"""case when channels = 1 then list_transform(samples, lambda x: x::double)
  else {_STEREO_DOWN} end"""

VOCAB_SIZE = 2000
PAIR_VOCAB_SIZE = 3000
LABEL_LANGUAGES = ["de", "en", "es", "fr"]
MAX_LABELS = 448
BATCH = 32


def _vocab(words: str, source: str, size: int) -> str:
    return f"""vocab as (
  select word, n, (row_number() over (order by n desc, word) + 3)::bigint as id
  from (select word, count(*) as n from (select unnest({words}) as word from {source}) group by word
        order by n desc, word limit {size}))"""


_LANGUAGE_TOKEN = (
    "case lang "
    + " ".join(f"when '{name}' then {4 + VOCAB_SIZE + i}" for i, name in enumerate(LABEL_LANGUAGES))
    + " else 3 end"
)

LABELS = f"""doc_words as (
  select doc_id as row_id, lang as "language", n_chars / 15::double as input_length, lang,
    {_words(_basic("text"))} as words from documents),
{_vocab("words", "doc_words", VOCAB_SIZE)},
spread as (
  select row_id, pos, coalesce(id, 3) as id
  from (select row_id, unnest(words) as word, generate_subscripts(words, 1) as pos from doc_words)
  left join vocab using (word)),
word_ids as (select row_id, list(id order by pos) as ids from spread group by row_id),
labelled as (
  select d.row_id, d."language", d.input_length,
    list_concat(list_concat([1, {_LANGUAGE_TOKEN}, {4 + VOCAB_SIZE + len(LABEL_LANGUAGES)}]::bigint[],
                            coalesce(ids, []::bigint[])), [2]::bigint[]) as labels
  from doc_words d left join word_ids using (row_id)),
in_range as (
  select * from labelled
  where input_length > 0 and input_length < 30 and len(labels) > 0 and len(labels) < {MAX_LABELS})"""

BATCHES = f"""{LABELS},
positions as (select *, row_number() over (order by md5('22:' || row_id), row_id) - 1 as position from in_range),
batches as (
  select row_id, position // {BATCH} as batch_id, position % {BATCH} as row_in_batch, labels from positions),
padded as (
  select * replace (list_concat(labels,
    list_transform(range(max(len(labels)) over (partition by batch_id) - len(labels)), lambda i: -100::bigint)) as labels)
  from batches)"""

_JOINED = "array_to_string(labels, ',') as labels"

_NOT_SYSTEM = "role <> 'system'"

# The stub transcriber of the catalog: every ninth word is misheard.
_STUB = """array_to_string(list_transform(string_split(reference, ' '),
  lambda x, i: case when (i - 1) % 9 = 4 then 'uh' else x end), ' ')"""

STUB_PAIRS = f"""{PAIRS},
stub_pairs as (
  select * from (select * replace ({_strict("reference")} as reference, {_strict(_STUB)} as hypothesis)
                 from pairs where {_NOT_SYSTEM})
  where trim(reference) <> '' and trim(hypothesis) <> '')"""

IN_VOCAB = f"""{PAIRS},
pair_words as (
  select conv_id, turn, {_words(_basic("reference"))} as r0, {_words(_basic("hypothesis"))} as h0 from pairs),
{_vocab("r0", "pair_words", PAIR_VOCAB_SIZE)},
known as (select list(word) as ws from vocab),
known_pairs as (
  select * from (
    select conv_id, turn, array_to_string(list_filter(r0, lambda w: list_contains(ws, w)), ' ') as reference,
      array_to_string(list_filter(h0, lambda w: list_contains(ws, w)), ' ') as hypothesis
    from pair_words, known)
  where reference <> '' and hypothesis <> '')"""

PAIRED = f"""media as (
  select replace(path, '/clip_', '/clip%20+') as media_path
  from (select concat({_HOST}, '/clip_', page_id, {_MEDIA_EXT}, case when page_id % 11 = 0 then '.part' else '' end) as path
        from pages)),
texts as (
  select concat({_HOST}, case when page_id % 13 = 0 then '/draft ' when page_id % 2 = 0 then '/clip +'
                         else '/clip%20+' end, page_id, {_TEXT_EXT}) as transcript_path from pages),
media_keys as (select *, url_decode({_stem(_basename("media_path"))}) as k from media),
text_keys as (select *, {_stem(f"url_decode({_basename('transcript_path')})")} as k from texts)"""

_DATASET = f"""{PAIRS},
dataset as (select audio_path, 16000::bigint as sample_rate, reference as sentence, "language" from pairs)"""

_HASH_100 = "('0x' || substr(md5(concat('0:', conv_id, ':', turn)), 1, 8))::bigint % 100"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Sources and sinks
    sql["read_manifest"] = f"with {MANIFEST} select * from manifest"
    sql["list_objects"] = """select lang as "language", source || '%20 a' as source,
        sum(strlen(text) + 1)::bigint as bytes from documents group by lang, source"""
    sql["read_lines"] = """select row_number() over (order by doc_id, pos) - 1 as line_no, value
      from (select doc_id, unnest(string_split(text, chr(10))) as value,
              generate_subscripts(string_split(text, chr(10)), 1) as pos from documents)"""
    sql["read_transcripts"] = """select role, line, count(*) as n
      from (select role, unnest(string_split(text, chr(10))) as line from conversations) group by role, line"""
    sql["load_datasets"] = f"""with {_DATASET}
      select 0::bigint as dataset_no, * from dataset
      union all select 1::bigint, * from dataset where "language" = 'fi'"""
    sql["write_clips"] = f"""with {FRAMES}
      select audio_id, cue_no, {_language("audio_id")} as "language",
        {_fixed("signal[start_ms * 64 // 1000 + 1 : end_ms * 64 // 1000]")} as samples
      from cues join signals using (audio_id)"""
    sql["write_pair_lists"] = f"""with {PAIRS}
      select "language", row_number() over (partition by "language" order by conv_id, turn) - 1 as line_no,
        audio_path as media, reference as sentence from pairs"""
    sql["write_dataset"] = f"with {_DATASET} select * from dataset"
    sql["write_results"] = f"""with {STRICT_PAIRS}
      select reference as "Reference", hypothesis as "Result", audio_path as "Audio_File", "language" from strict_pairs"""
    sql["run_summary"] = f"""with {RESOLVED}, {FETCHED},
      acquired as ({_ACQUIRED}),
      cutting as (
        select case when media_file is null or transcript_file is null then 'incomplete'
          when {_stem("media_file")} || '.wav' not in (select name from fetched_audio)
            or transcript_file not in (select {_basename("path")} from listing) then 'missing'
          when not regexp_matches(transcript_file, '\\.(srt|vtt)$') then 'unsupported' else 'to_cut' end as status
        from manifest)
      select 'acquire' as stage, status, count(*) as n from acquired group by status
      union all select 'cut', status, count(*) from cutting group by status"""

    # Path and text functions
    for name, expr in {
        "path_basename": _basename("url"),
        "path_rstem": _rstem("url"),
    }.items():
        sql[name] = f"select page_id, {expr} as value from pages"
    sql["path_stem"] = rf"""select page_id, regexp_replace({_basename("url")}, '{_EXT_RE}', '\1') as value from pages"""
    sql["audio_target"] = f"""with {LISTING} select path, {_audio_name("path")} as audio_name from listing"""
    sql["media_kind"] = f"with {MANIFEST} select manifest_id, {_kind('media_file')} as kind from manifest where media_file is not null"
    sql["transcript_kind"] = f"""with {MANIFEST} select manifest_id,
      case when ends_with(transcript_file, '.srt') then 'srt' when ends_with(transcript_file, '.vtt') then 'vtt'
           else 'unsupported' end as kind from manifest"""
    sql["url_unquote"] = """select page_id,
      url_decode(concat(url, '+', replace(replace(html, ' ', '%20'), 'e', '%65'))) as value from pages"""
    sql["fold_newlines"] = r"""select doc_id,
      regexp_replace(replace(text, chr(10), chr(13) || chr(10)) || chr(13) || chr(10) || chr(10), '\r\n|\r|\n', ' ', 'g')
      as value from documents"""
    sql["strip_ws"] = "select doc_id, text as value from documents"
    sql["norm_strict"] = f"select doc_id, {_strict('text')} as value from documents"
    sql["norm_basic"] = f"select doc_id, {_basic('text')} as value from documents"
    sql["word_tokens"] = f"select doc_id, len({_words('text')})::bigint as n, array_to_string({_words('text')}, '|') as words from documents"

    # Filters
    sql["manifest_complete"] = f"with {MANIFEST} select * from manifest where media_file is not null and transcript_file is not null"
    sql["exclude_names"] = f"with {LISTING} select * from listing where not contains(path, 'example.net') and not contains(path, 'm.th')"
    sql["supported_only"] = f"with {MANIFEST} select * from manifest where regexp_matches(transcript_file, '\\.(srt|vtt)$')"
    sql["length_range"] = f"""with {LABELS} select row_id, "language", input_length, {_JOINED} from in_range"""
    sql["nonempty_pairs"] = f"with {STRICT_PAIRS} select conv_id, turn, reference, hypothesis from strict_pairs"
    sql["progress_sample"] = f"""with {STRICT_PAIRS}
      select conv_id, turn, "language", position, reference from (
        select *, row_number() over (partition by "language" order by conv_id, turn) - 1 as position from strict_pairs)
      where position % 100 = 10"""

    # Joins
    listed = """listed as (select 'clip_' || doc_id || case when doc_id % 3 = 0 then '.' else '/' end as text from documents
        union all select '_' || s_suppkey || 'x.mp3' from supplier)"""
    sql["plan_with_list"] = f"""with {RESOLVED}, {FETCHED}, {listed},
      plan as ({_ACQUIRED})
      select * replace (case when status in ('present', 'to_fetch') and exists (
        select 1 from listed where contains(media_path, text) or contains(transcript_path, text)) then 'excluded' else status end as status)
      from plan"""
    sql["exclude_listed"] = f"""with {LISTING}, {listed}
      select * from listing where not exists (select 1 from listed where contains(path, text))"""
    sql["resolve_names"] = f"with {RESOLVED} select * from resolved"
    sql["resolve_exact"] = f"""with {MANIFEST}, {LISTING}
      select m.*, (select min(path) from listing where {_basename("path")} = m.media_file) as media_path,
        (select min(path) from listing where {_basename("path")} = m.transcript_file) as transcript_path
      from manifest m"""
    sql["skip_present"] = f"""with {RESOLVED}, {FETCHED}
      select * from resolved where media_path is null or {_audio_name("media_path")} not in (select name from fetched_audio)"""
    sql["both_files_exist"] = f"""with {MANIFEST}, {LISTING}, {FETCHED}
      select * from manifest where {_stem("media_file")} || '.wav' in (select name from fetched_audio)
        and transcript_file in (select {_basename("path")} from listing)"""
    sql["acquisition_plan"] = f"with {RESOLVED}, {FETCHED} {_ACQUIRED}"
    sql["skip_done_clips"] = f"""with {CUE_LINES}
      select s.conv_id, s.turn, s.cue_no, s.start_ms, s.end_ms, s.text
      from srt s join conversations c using (conv_id, turn) where c.role = 'system'"""
    sql["cut_frames"] = f"""with {FRAMES}
      select audio_id, cue_no, 0::bigint as part_no,
        {_fixed("signal[start_ms * 64 // 1000 + 1 : end_ms * 64 // 1000]")} as samples
      from cues join signals using (audio_id)"""
    sql["cut_uneven_frames"] = f"""with
      sizes as (select vec_id // 50 as audio_id, vec_id % 50 as frame_no, embedding,
        unnest(range(1, 64 + (vec_id % 50) % 2)) as i from embeddings where vec_id % 50 not in (17, 18, 40)),
      signal as (select audio_id, frame_no * 25 * 2540 // 1000 + i - 1 as place, embedding[i] as x from sizes),
      total as (select audio_id, max(place) + 1 as total from signal group by audio_id),
      cues as (select case when vec_id % 29 = 0 then -1 else vec_id // 50 end as audio_id, vec_id % 50 as cue_no,
        vec_id % 50 * 26 + 7 as s, vec_id % 50 * 26 + 7 + (vec_id * 37) % 520 - 20 as e from embeddings),
      spans as (select *, greatest(s, 0) * 2540 // 1000 as lo, if(total is null, 0, least(greatest(e, 0) * 2540 // 1000, total)) as hi
        from cues left join total using (audio_id)),
      parts as (select *, unnest(case when hi > lo then range(0, (hi - lo - 1) // 254 + 1) else [0] end) as part_no from spans),
      cut as (select *, lo + part_no * 254 as a, least(hi, lo + part_no * 254 + 254) as b from parts),
      clips as (select c.audio_id, c.cue_no, c.s, c.e, c.part_no, c.total, c.lo, c.hi, c.a, c.b,
          coalesce(list(x order by place) filter (x is not null), []) as samples
        from cut c left join signal g on g.audio_id = c.audio_id and g.place >= c.a and g.place < c.b group by all)
      select audio_id, cue_no, part_no::bigint as part_no,
        case when total is null then 'no_audio' when not hi > lo then 'empty'
          when len(samples) < b - a then 'gap' else 'ok' end as status,
        (case when hi > lo then b - a - len(samples) else 0 end)::bigint as missing,
        {_fixed("samples")} as samples
      from clips"""
    sql["cut_clips"] = f"""with {CUE_LINES}, {FRAMES},
      mono_signals as (
        select audio_id, flatten(list({_STEREO_DOWN} order by frame_no)) as mono from frames group by audio_id)
      select concat('rec_', conv_id, '_', cue_no) as clip_id, {_language("conv_id")} as "language",
        concat('conv_', conv_id, '_', turn, case role when 'user' then '.srt' else '.vtt' end) as transcript_file,
        text, 0::bigint as part_no, {_fixed("mono[start_ms * 64 // 1000 + 1 : end_ms * 64 // 1000]")} as samples
      from mixed join (select conv_id, turn, role from conversations) using (conv_id, turn)
      join mono_signals on audio_id = conv_id"""
    sql["paired_dataset"] = f"""select concat('media/conv ', conv_id, '+', turn, '.wav') as audio_path,
      16000::bigint as sample_rate, replace(text, chr(10), ' ') as sentence, {_language("conv_id")} as "language"
      from conversations where {_NOT_SYSTEM}"""
    sql["pair_clips"] = f"""with {PAIRED}
      select m.media_path, min(t.transcript_path) as transcript_path
      from media_keys m join text_keys t using (k) group by m.media_path"""
    sql["unpaired_media"] = f"with {PAIRED} select media_path from media_keys where k not in (select k from text_keys)"
    sql["zip_lines"] = """select row_number() over (order by doc_id) - 1 as line_no, source as media,
      replace(text, chr(10), ' ') as sentence from documents"""
    sql["audio_exists"] = f"""with {PAIRS} select conv_id, turn, audio_path from pairs where {_NOT_SYSTEM}"""

    # Generators
    columns = "conv_id, turn, cue_no::bigint as cue_no, start_ms::bigint as start_ms, end_ms::bigint as end_ms, text"
    for name, source in {"srt_cues": "srt", "vtt_cues": "vtt", "all_cues": "mixed"}.items():
        sql[name] = f"with {CUE_LINES} select {columns} from {source}"
    sql["clip_ids"] = f"""with {CUE_LINES}
      select concat('conv_', conv_id, '_', turn, '_', cue_no) as clip_id, conv_id, turn, cue_no::bigint as cue_no from mixed"""
    sql["rejected_blocks"] = """select conv_id, turn,
      case role when 'user' then 'bad_blocks' when 'assistant' then 'parsed' else 'unsupported' end as status,
      case role when 'user' then 1 else 0 end::bigint as blocks from conversations"""
    sql["stream_new_cues"] = f"with {CUE_LINES} select concat('conv_', conv_id, '_', turn, '_', cue_no) as clip_id, start_ms::bigint as start_ms, text from mixed"

    sql["stream_file_status"] = """select concat('conv_', conv_id, '_', turn,
        case role when 'user' then '.srt' when 'assistant' then '.vtt' else '.txt' end) as file,
      case role when 'user' then 'bad_blocks' when 'assistant' then 'parsed' else 'unsupported' end as status,
      case role when 'user' then 1 else 0 end::bigint as blocks,
      case when role in ('user', 'assistant') then len(string_split(text, chr(10))) else 0 end::bigint as cues
      from conversations"""

    # Signals
    sql["mixdown_mono"] = f"with {FRAMES} select audio_id, frame_no, {_fixed(_MIXED_DOWN)} as samples from frames"
    sql["clip_duration"] = f"""with {FRAMES}
      select audio_id, 64::bigint as sample_rate, sum(len(samples) // channels) / 64::double as input_length
      from frames group by audio_id"""
    sql["rate_check"] = f"""with {FRAMES}
      select case when label % 2 = 0 then 'ok' else 'needs_resample' end as rate_status, count(*) as n
      from frames group by rate_status"""

    # Dataset
    sql["build_dataset"] = f"with {_DATASET} select * from dataset"
    sql["concat_datasets"] = f"with {_DATASET} select * from dataset union all select * from dataset"
    sql["seeded_shuffle"] = f"""with {PAIRS}
      select conv_id, turn, row_number() over (order by md5(concat('22:', conv_id, ':', turn)), conv_id, turn) - 1
        as position from pairs"""
    sql["train_eval_split"] = f"""with {PAIRS}
      select conv_id, turn, "language", case when {_HASH_100} < 80 then 'train' else 'eval' end as split from pairs"""
    sql["exact_split"] = """select row_id, "language", case when place <= n * 73 // 100 then 'train' else 'eval' end as split
      from (select doc_id as row_id, lang as "language", count(*) over (partition by lang) as n,
        row_number() over (partition by lang order by md5('22:' || doc_id), doc_id) as place from documents)"""
    sql["language_summary"] = f"""select lang as "language", count(*) as clips,
      sum(len({_words("text")}))::bigint as words, round(sum(n_chars / 15::double), 4) as seconds
      from documents group by lang"""

    # Labels and batches
    sql["build_vocab"] = f"with {LABELS} select word, n, id from vocab"
    sql["encode_labels"] = f"""with {LABELS} select row_id, {_JOINED} from labelled"""
    sql["decode_labels"] = f"""with {LABELS}
      select row_id, coalesce(string_agg(word, ' ' order by pos), '') as text
      from (select row_id, pos, v.word from spread s join vocab v using (id)) right join doc_words using (row_id)
      group by row_id"""
    sql["assign_batches"] = f"with {BATCHES} select row_id, batch_id, row_in_batch from batches"
    sql["batches_by_split"] = f"""with {PAIRS},
      split as (select conv_id, turn, case when {_HASH_100} < 80 then 'train' else 'eval' end as split from pairs),
      placed as (select *, row_number() over
        (partition by split order by md5(concat('22:', conv_id, ':', turn)), conv_id, turn) - 1 as place from split)
      select conv_id, turn, split, place // {BATCH} as batch_id, place % {BATCH} as row_in_batch from placed"""
    sql["pad_batches"] = f"with {BATCHES} select row_id, batch_id, row_in_batch, {_JOINED} from padded"
    sql["strip_bos"] = f"""with {BATCHES}
      select row_id, batch_id, row_in_batch, array_to_string(labels[2:], ',') as labels from padded"""
    sql["unmask_labels"] = f"""with {BATCHES}
      select row_id, array_to_string(list_transform(labels, lambda x: case when x = -100 then 0 else x end), ',') as labels
      from padded"""

    # Metrics
    sql["edit_distance"] = f"with recursive {SCORED} select conv_id, turn, ref_words, edits from counts"
    sql["edit_counts"] = f"with recursive {SCORED} select * from counts"
    sql["corpus_wer"] = f"with recursive {SCORED} select {_WER} from counts"
    sql["corpus_edit_totals"] = f"""with recursive {SCORED}
      select sum(substitutions)::bigint as substitutions, sum(deletions)::bigint as deletions,
        sum(insertions)::bigint as insertions from counts"""
    sql["wer_by_language"] = f"""with recursive {SCORED}
      select "language", grouping("language") = 1 as is_corpus, count(*) as pairs,
        sum(ref_words)::bigint as ref_words, sum(edits)::bigint as edits, {_WER}
      from counts join strict_pairs using (conv_id, turn) group by rollup("language")"""
    sql["result_rows"] = sql["write_results"]
    sql["train_metric_wer"] = f"with recursive {IN_VOCAB}, {_aligned('known_pairs')} select {_WER} from counts"
    sql["best_checkpoint"] = """select event_type as run, arg_min(event_id, (value, event_id)) as step, min(value) as wer
      from events group by event_type"""
    sql["retained_checkpoints"] = """with ranked as (
        select event_type as run, event_id as step, value as wer,
          row_number() over (partition by event_type order by value, event_id) = 1 as is_best from events)
      select run, step, wer, is_best from ranked
      qualify row_number() over (partition by run order by is_best desc, step desc) <= 10"""

    # User functions
    sql["map_batches"] = f"with {PAIRS} select conv_id, turn, {_STUB} as hypothesis from pairs"
    sql["transcribe_and_score"] = f"""with recursive {STUB_PAIRS}, {_aligned("stub_pairs")} select * from counts"""
    return sql


_ACQUIRED = f"""select manifest_id, media_file, transcript_file, "language", media_path, transcript_path,
    {_kind("media_path")} as media_kind, {_audio_name("media_path")} as audio_name,
    coalesce({_basename("transcript_path")} in (select name from fetched_text), false) as transcript_present,
    case when media_file is null or transcript_file is null then 'incomplete'
      when media_path is null or transcript_path is null then 'unresolved'
      when contains(media_path, 'example.net') or contains(transcript_path, 'example.net') then 'excluded'
      when {_audio_name("media_path")} in (select name from fetched_audio) then 'present'
      else 'to_fetch' end as status
  from resolved"""
