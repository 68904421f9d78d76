from salesmart.jobs import main

main()
