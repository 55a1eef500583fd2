from chesstally.cli import main

raise SystemExit(main())
