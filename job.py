"""Entry script for spark-submit; see `pagetide/__main__.py` for the commands."""

from pagetide.__main__ import main

if __name__ == "__main__":
    main()
