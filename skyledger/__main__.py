from skyledger.cli import main

main()
