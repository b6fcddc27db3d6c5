"""Record schemas of the data model."""

PAGE = (
    "title string, ns bigint, id bigint, redirect_title string, "
    "revision array<struct<id:bigint,parentid:bigint,timestamp:string,"
    "contributor:struct<username:string,id:bigint,ip:string>,minor:boolean,"
    "model:string,format:string,sha1:string,text:string>>"
)
TEXT_DOCUMENT = "primary string, secondary array<string>, tokens array<string>, url string"
TOKEN_STAT = "token string, url string, frequency bigint, doc_frequency bigint, index bigint"
SPARSE_DOCUMENT = (
    "url string, primary_index bigint, secondary_index array<bigint>, "
    "token_index array<bigint>, token_tfidf array<double>"
)
COOCCURRENCE_ROW = "index bigint, other_index array<bigint>, count array<double>"

RECORD_KINDS = {
    "page": PAGE,
    "text_document": TEXT_DOCUMENT,
    "token_stat": TOKEN_STAT,
    "sparse_document": SPARSE_DOCUMENT,
    "cooccurrence_row": COOCCURRENCE_ROW,
}

# One page element as the XML reader sees it: an attribute becomes a field with a
# leading underscore, and the text of an element that has attributes becomes _VALUE.
PAGE_XML = (
    "title string, ns bigint, id bigint, redirect struct<_title:string,_VALUE:string>, "
    "revision array<struct<id:bigint,parentid:bigint,timestamp:string,"
    "contributor:struct<username:string,id:bigint,ip:string>,minor:string,"
    "model:string,format:string,sha1:string,text:struct<_VALUE:string,_bytes:bigint>>>"
)
PLAYLIST_FILE = (
    "playlists array<struct<num_tracks:bigint,tracks:array<struct<"
    "track_uri:string,artist_uri:string,album_uri:string>>>>"
)
SCENE_PRODUCT = "product string, scene string, bbox array<double>"
EXAMPLE = (
    "track_context array<bigint>, album_context array<bigint>, artist_context array<bigint>, "
    "next_track array<bigint>, next_album array<bigint>, next_artist array<bigint>"
)
