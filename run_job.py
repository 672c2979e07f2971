"""Entry point for spark-submit; see ``stratakeep.__main__``."""

from stratakeep.__main__ import main

if __name__ == "__main__":
    main()
