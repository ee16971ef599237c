from tramline.cli import main

main()
