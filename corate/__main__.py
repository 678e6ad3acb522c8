import sys

from corate.cli import main

main(sys.argv[1:])
