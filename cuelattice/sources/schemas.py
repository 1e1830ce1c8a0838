"""Explicit schemas of every dataset; nothing is inferred."""

WORD = "struct<text:string,start:double,end:double>"
CHUNK_FIELDS = "id:string,chapter_id:int,chapter_title:string,part:int,start_frame:bigint,end_frame:bigint,start:double,end:double,duration:double"
CHUNK = CHUNK_FIELDS.replace(":", " ").replace(",", ", ")
MANIFEST = f"audio string, sample_rate int, target_seconds double, search_seconds double, max_seconds double, chunks array<struct<{CHUNK_FIELDS}>>"
PROBE = "chapters array<struct<id:int,start_time:string,end_time:string,tags:map<string,string>>>"
TRANSCRIPTION = f"{CHUNK}, model string, aligner string, language string, text string, words array<{WORD}>, elapsed_seconds double"
CONSENSUS = f"{CHUNK}, editor_model string, method string, similarity double, a_word_count int, b_word_count int, consensus_word_count int, text string, elapsed_seconds double"
ALIGNED = f"{CHUNK}, aligner string, text string, words array<{WORD}>, raw_word_count int, surface_word_count int, surface_restored boolean, elapsed_seconds double"
FUSED = f"{ALIGNED}, fused_word_timings int"
STREAMS = "array<struct<index:int,codec_name:string,codec_type:string,channels:int,channel_layout:string,disposition:map<string,int>,tags:map<string,string>>>"
MEDIA = f"format struct<duration:string,size:string>, streams {STREAMS}, chapters array<struct<id:int>>"
JOB = "id string, source string, work_dir string, output_dir string, output_basename string, glossary_file string"
CONFIG = (
    "jobs array<struct<id:string,source:string,work_dir:string,output_dir:string,output_basename:string,glossary_file:string>>, "
    "editor struct<script:string,model:string,base_url_env:string>, runtime struct<qwen_batch_size:int,whisper_batch_size:int,whisper_input_group_size:int>"
)
