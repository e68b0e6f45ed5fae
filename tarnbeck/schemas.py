"""Schemas of the tables that stages exchange."""

SEGMENTS = "array<struct<start:double,end:double,text:string,speaker:string>>"
SCENES = "array<struct<scene_index:int,start_sec:double,end_sec:double,keyframe_path:string,phash:bigint>>"
IMAGE = "struct<width:int,height:int,format:string,exif:map<string,string>,ocr_text:string,caption:string,phash:bigint,is_duplicate:boolean,exif_stripped:boolean>"
AUDIO = "struct<duration_sec:double,sample_rate:int,channels:int,codec:string>"
VIDEO = "struct<duration_sec:double,width:int,height:int,fps:double,codec:string,scene_count:int>"

#: Columns of a parsed document and their types.
DOCS = {
    "doc_id": "string",
    "source_key": "string",
    "modality": "string",
    "content_text": "string",
    "media_path": "string",
    "media_bytes_len": "bigint",
    "segments": SEGMENTS,
    "scenes": SCENES,
    "image": IMAGE,
    "audio": AUDIO,
    "video": VIDEO,
    "content": "binary",
    "frames": "array<binary>",
    "status": "string",
    "reason": "string",
}
PROBE = (
    "struct<format:struct<duration:string>,streams:array<struct<codec_type:string,codec_name:string,duration:string,"
    "width:int,height:int,avg_frame_rate:string,sample_rate:string,channels:int>>>"
)
EVENT = "struct<detail:struct<object:struct<key:string>,bucket:struct<name:string>>>"
