import re
from pathlib import Path

DATA = Path("/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
