"""Values that must equal the original jobs' for the same results.

Everything else in the library is derived from these or is a parameter.
"""

# Sentinels and separators of the data model.
LABEL_SEPARATOR = "#"  # composite keys "title#artist", "series#year"
MISSING = ""  # attribute absent in a candidate, or no candidate
NO_MATCH = "NONE"  # ranking row without an origin match, or match without a begin area
NULL_EPISODE = "null"  # literal text in the ratings episode field
FIELD_SEPARATOR = ","  # removed from output fields
ARTIST_STOP_CHARACTER = "&"  # removed from artist names before searching
DOUBLE_SPACE = "  "  # replaced by one space, in a single pass
WORD_SEPARATOR = " "

# Default parameters of the original reports.
TOP_POSITION = 1
TOP_YEAR = "2017"
HOLIDAY_DATE = "2017-12-25"
HOME_REGION = "cl"
SERIES_TYPE = "TV_SERIES"

# File layouts.
RANKING_HEADER = ("Position", "Track Name", "Artist", "Streams", "URL", "Date", "Region")
EXTENDED_HEADER = RANKING_HEADER + ("Country", "Begin_area")
RESOLVED_HEADER = ("artist", "song", "result_artist", "country", "starting_place")
SERIES_FIELD_POSITIONS = {2: "rating", 3: "series", 4: "year", 6: "type", 7: "episode"}

# Element and attribute names of the search responses.
ARTIST_LIST = "artist-list"
ARTIST = "artist"
BEGIN_AREA = "begin-area"
WORK_LIST = "work-list"
WORK = "work"
RELATION_LIST = "relation-list"
RELATION = "relation"
TARGET_TYPE = "target-type"
ARTIST_TARGET = "artist"
# The white space that is trimmed from element text.
WHITE_SPACE = (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
               "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
