"""Classes of words in seven languages, with weights, and the patterns in which they are abusive.

Plain text, entries separated by semicolons. An entry says nothing by itself unless its class has a pattern of
its own: an insult needs somebody it is aimed at, a harmful act somebody it is meant for, what degrades needs a
group of people. A star is any number of letters at the end of a word: "insult*" stands for what is in ENDINGS.
"""

#: Somebody is addressed, as the one who is, does or gets something.
YOU = """
you; u; ya; yourself; your self; you all; you guys; you lot; du; dich; dir; ihr; euch; te; ti; tu; usted; ustedes; vos; toi; vous; voce; voces; vc; 你; 你们; 您; お前; おまえ; あんた; きさま; 貴様; てめえ
"""
YOUR = """
your; ur; yours; dein; deine; deinen; deiner; deinem; eure; tus; tu; vuestro; ton; ta; tes; votre; vos; seu; sua; seus; suas; teu; tua; teus; tuas; 你的; 您的; お前の; あんたの
"""
#: Somebody is said to be something.
IS = """
you are; youre; you were; ur; u r; he is; hes; she is; shes; is a; is an; is such; was a; was an; are a; are an; are such; such a; such an; what a; what an; only a; only an; just a; just an; another; like a; like an; id call; would call; call you; call him; call her; called me a; you are such; a bunch of; bunch of; pack of; must be a; must be an; you call yourself
du bist; ihr seid; bist du; ist ein; ist eine; was fur ein; eres; eres un; eres una; es un; es una; sois; menudo; un; una; tu es; t'es; vous etes; est un; est une; quel; quelle; espece de; espece d; pauvre; voce e; voce e um; voce e uma; tu es um; es um; es uma; e um; e uma; seu; sua; 你是; 你就是; 就是个; 就是一个; 你这; 这个; 你真是; 真是; 是个; お前は; あなたは; この; ほんとに; 本当に; まじで; マジで; は本当に
so ein; so eine; so eine blode; gros; grosse; sale
"""
YOU_ARE = """
you are; youre; you were; you re; ur a; ur an; ur such; u r; u are; you all are; you are all; are you a; are you an; you little; you absolute; you complete; you total; you utter; you fucking; du bist; ihr seid; bist du; du; eres; eres un; eres una; sois; tu es; t'es; vous etes; tu n'es qu'un; espece de; espece d; voce e; voce nao passa de; tu es; es um; es uma; seu; sua; 你是; 你就是; 你这; 你真是; 你们是; お前は; おまえは; あんたは; この; 本当に
"""
#: Somebody gives somebody a name.
CALL = """
id call; i d call; i would call; i call; call you; calling you; calls you; called you; call him; call her; ich nenne dich; nenn ich; te llamo; yo llamo; je t'appelle; eu chamo; te chamo
"""
#: How much of something one has to be.
DEGREE = """
do you have to be; can you be; can you get; are you; must you be; can one person be; muss man; 多么; どれだけ
how; so; wie; tan; tao; si
"""
#: Insults that are nothing else when somebody is meant.
INSULT = """
moron*; idiot*; imbecile*; cretin*; retard*; scumbag*; asshole*; arsehole*; dickhead*; dipshit*; shithead*; dumbass*; dumbfuck*; fuckwit*; fucktard*; wanker*; tosser*; twat*; cunt*; halfwit*; half wit*; nitwit*; dimwit*; numbskull*; simpleton*; bonehead*; blockhead*; airhead*; fuckface*; motherfucker*; son of a bitch; sons of bitches; douchebag*; douche*; jackass*; lowlife*; piece of shit; piece of garbage; piece of trash; piece of crap; sack of shit; bag of shit; whore*; slut*; skank*; bastard*; bitch*; buffoon*; imbecilic; braindead; brain dead; braindamaged; brain damaged; brainless; subhuman*; degenerate*; pervert*; sleazebag*; dirtbag*; schmuck*; nutjob*; ignoramus; dunce*; dolt*; oaf*
arschloch; arschlocher; wichser; hurensohn; missgeburt; idiot; idioten; vollidiot; vollidioten; trottel; penner; versager; depp; deppen; vollpfosten; drecksau; drecksack; schlampe; fotze; spast; spasti; mongo; hirntot; dummkopf; schwachkopf; flachzange; dreckskerl; abschaum; untermensch; miststuck; hure; nutte; wixer
gilipollas; imbecil; imbeciles; idiota; idiotas; estupido; estupida; cabron; cabrona; pendejo; pendeja; hijo de puta; hija de puta; hijo de perra; subnormal; tarado; tarada; maricon; capullo; cretina; idiota de mierda; mamon
connard; connards; connasse; abruti; abrutie; debile; salope; salaud; encule; enfoire; batard; ordure; imbecile; raclure; minable; bouffon; fils de pute; fille de pute; idiot; idiote; pourriture
babaca; otario; otaria; imbecil; idiota; vagabunda; vadia; desgracado; desgracada; canalha; cuzao; arrombado; nojento; nojenta; retardado; retardada; escroto; trouxa; filho da puta; filha da puta
白痴; 废物; 笨蛋; 蠢货; 蠢猪; 蠢驴; 贱货; 贱人; 弱智; 智障; 傻瓜; 傻逼; 傻子; 脑残; 混蛋; 王八蛋; 人渣; 狗东西; 猪头; 饭桶
バカ; ばか; 馬鹿; クズ; アホ; あほ; 能無し; 間抜け; まぬけ; ブス; 役立たず; 低能; 馬鹿野郎; ばか野郎; くそ野郎; クソ野郎
loser; losers; prick; pricks; cretino; cretina; cretin; cretine; pute; puta; perra; zorra; escoria; loser de merde; pedazo de mierda; sac a merde; monte de merda; カスが; 無能が; 使えない奴; 使えない人間
"""
#: Words that insult only when they are aimed well: animals, things, roles.
DEMEANING = """
clown*; parasite*; maggot*; cockroach*; slug*; swine; pig*; donkey*; monkey*; toddler*; amoeba*; turd*; troll*; liar*; fraud*; coward*; creep*; jerk*; hag*; worm*; leech*; weasel*; psycho*; freak*
dog; rat; rats; ape; apes; snake; cow; animal; animals; monster; beast; burro; burra; cerdo; cerda; tonto; tonta; payaso; vaca; porco; porca; verme; palhaco; porc; ane; schwein; sau; esel; vermin; 猪; 豚
"""
#: Words for things without worth, said of a person.
REFUSE = """
joke; waste; disgrace; embarrassment; failure; filth; scum; trash; garbage; shit; crap; nobody; nothing; a zero; abfall; dreck; mull; eine null; basura; mierda; inutil; un cero; merde; ordure; nul; nulle; incapable; lixo; merda; inutil; um nada; 垃圾; 废物; ゴミ; カス; くず; 無能
"""
EXCUSE = """
excuse for a; excuse for an; excuse of a; entschuldigung von einem; remedo de; parodie de
"""
AWARD = """
of the month; of the year; of the week; of the day; of the century; des monats; des jahres; del mes; del ano; du mois; de l'annee; do mes; do ano
"""
#: What people are said to be like.
ADJECTIVE = """
stupid; dumb; worthless; pathetic; useless; clueless; revolting; disgusting; miserable; arrogant; thick; spineless; incompetent; ugly; fat; filthy; dirty; vile; gutless; ignorant; lazy; rotten; pitiful; repulsive; hopeless; mindless; moronic; idiotic; retarded; braindead; brain dead; brainless; brain damaged; braindamaged; twisted; inbred; smug; two faced; mentally ill; deranged; slimy; imbecilic; obnoxious; nasty; shitty; crappy; daft
dumm; damlich; blod; dreckig; faul; hasslich; hirnlos; unfahig; wertlos; jammerlich; erbarmlich; peinlich; ekelhaft; estupido; estupida; inutil; asqueroso; asquerosa; patetico; patetica; stupide; debile; minable; pathetique; ridicule; estupido; nojento; patetico; ridiculo; inutil; 蠢; 笨; 臭; 恶心; 无耻; 愚蠢; 可悲; 最低
"""
#: Words that make an insult stronger and say nothing by themselves.
INTENSIFIER = """
fucking; bloody; damn; goddamn; total; complete; absolute; utter; verdammter; verdammte; verdammtes; elender; elende; maldito; maldita; puto; puta; putain de; sale; くそ; クソ
lying; two faced
"""
#: Things that may be stupid or useless without harm, right behind the word.
THING = """
question*; bug*; typo*; mistake*; error*; script*; code; scheduler; queue; job*; process*; pod*; terminal*; thing*; idea*; config*; cluster; file*; test*; test; plot*; hack*; name*; format; flag*; proof; luck; default*; api; parser; loop; server*; script; pipeline; warning*; log*; data; model; metric*; regex; computer; machine; software; printer; compiler; driver*; node*; result*; statistic*; p value; layer*; film; slice*; film*; section; clients; client; switch*; pipe*; luck; light
"""
#: Orders to be gone or be silent, and curses: nothing else, at whomever.
DISMISS = """
fuck off; fuck you; fuck u; fuck ya; fuck yourself; go fuck; screw you; screw yourself; go screw; piss off; sod off; bugger off; eat shit; kiss my ass; kiss my arse; suck my dick; suck my cock; shut the fuck up; shut the hell up; stfu; gtfo; shut your mouth; shut your trap; shut your face; shut your gob; shut your hole; shut your pie hole; shut your dirty mouth; shut your stupid mouth; shut it you; shut up you; get lost you; go to hell; rot in hell; burn in hell; up yours; bite me you
crawl back under; crawl back into; crawl back to; slither back; creep back under; crawl into a hole; go back to your hole; go back to your cave; under your rock
verpiss dich; verpisst euch; halt die fresse; halt deine fresse; halt dein maul; halts maul; halt das maul; halt die klappe; halt deine klappe; haltet die klappe; leck mich; fick dich; fickt euch; fahr zur holle; scher dich zum teufel; verzieh dich; hau ab du
callate idiota; callate imbecil; callate de una vez; callate la boca; cierra la boca; cierra el pico; vete a la mierda; vete al infierno; vete al carajo; vete al diablo; vete a la puta; vete a tomar por culo; que te jodan; que te den; que te follen; jodete; chinga tu madre; chingate; me cago en tu
ta gueule; ferme la; ferme ta gueule; ferme ta bouche; ferme ta sale gueule; ferme ton clapet; vos gueules; va te faire; allez vous faire; va te faire foutre; va te faire enculer; va te faire voir; nique ta mere; nique ta race; casse toi; va au diable; va crever; degage connard; degage de la
cala a boca; cale a boca; cala essa boca; cala a tua boca; fecha a boca; vai se foder; vai te foder; va se foder; vao se foder; vai tomar no cu; vai se ferrar; vai a merda; vai pro inferno; vai para o inferno; some daqui; vai a puta que te pariu; vai pra puta
闭嘴; 住嘴; 闭上你的; 闭上臭嘴; 滚出; 滚开; 滚蛋; 滚回; 去你妈; 去你的; 操你; 草泥马; 他妈的你; 你妈的; 日你
黙れ; だまれ; 消えろ; 失せろ; うせろ; 出て行け; 出ていけ; くたばれ; 死ね; しね; くたばっちまえ
to hell with you; to hell and; ab in die holle; al infierno contigo; au diable; pro inferno com voce
"""
#: To die or suffer, in words that command or wish it.
HARM = """
kill yourself; kys; go kill; hang yourself; neck yourself; shoot yourself; drown yourself; off yourself; end yourself; go die; drop dead; go hang; drink bleach; swallow bleach; jump off a bridge; jump off the bridge; jump off a cliff; jump off the roof; jump off a roof; jump off the building; jump out of the window; jump out a window; jump in front of a train; jump in front of a bus; jump in front of a truck; jump under a train; die in a; die in pain; die slowly; die painfully; die alone; die already; blow your brains out; slit your wrists; cut your wrists
bring dich um; bringt euch um; hang dich auf; erhang dich; erschiess dich; geh sterben; stirb; spring vom dach; spring aus dem fenster; spring von der brucke; vor den zug; matate; suicidate; muerete; tirate por la ventana; tirate de un puente; cuelgate; tue toi; suicide toi; pends toi; va mourir; creve; jette toi; saute par la fenetre; se mata; mata te; te mata; se enforca; morre; pula da ponte; pula da janela; se joga da; 去死; 自杀吧; 去跳楼; 跳楼吧; 不得好死; 死ねばいい; 死んでしまえ; 首を吊れ; 飛び降りろ; 自殺しろ
you should die; you should all die; you should kill; you deserve to die; hoffentlich stirbst du; 你该死; 死んだ方がいい
"""
#: Wishing, and what may be wished to somebody.
WISH = """
hope you; hope you all; i hope he; i hope she; hope your; wish you would; wish you; wish he; i wish she; you deserve to; he deserves to; she deserves to; want you to; would love to see you; cant wait for you to; can not wait for you to; may you; why dont you; somebody should make you; do us all a favour and; do us all a favor and; do us a favour and; do us a favor and; do everyone a favour and; do everyone a favor and; do the world a favour and; do the world a favor and; ich hoffe; tu uns einen gefallen und; ojala; j'espere que; pourvu que; tomara que; espero que voce; 希望你; 祝你; 愿你; ことを願う
"""
FATE = """
die; choke; choke on; suffer; rot; burn; drown; suffocate; bleed; bleed out; get cancer; get hit by; get run over; get raped; fall down the stairs; break your neck; never wake up; crash your car; disappear forever; end up alone; end up in a grave; stirbst; verreckst; erstickst; krepierst; krebs; sterben; te mueras; mueras; revientes; te pudras; sufras; cancer; creves; meures; souffres; brules; etouffes; morra; sofra; apodreca; queime; engasgue; 死; 癌; 早死; 死ぬ; 苦しむ
"""
#: Announcing, and what is done to somebody.
WILL = """
i will; i ll; ill; i am going to; im going to; i am gonna; im gonna; gonna; going to; we will; well; we are going to; were going to; i shall; i swear; someone will; somebody will; somebody should; someone should; id love to; i want to; i would love to; i could; i might; let me; wait until i; until i; before i; if i see; if i catch; come and; i would; ich werde; ich mach; ich will; wir werden; bevor ich; ich; te voy a; os voy a; voy a; le voy a; antes de que; je vais; on va; nous allons; avant que je; vou; vamos; vou te; antes que eu; 我要; 我会; 我就; 老子; 小心我; 俺が; 俺は; 俺; 今すぐ; 絶対
"""
DO_TO_YOU = """
kill you; hurt you; beat you; beat you up; punch you; slap you; smack you; kick you; stab you; shoot you; strangle you; choke you; destroy you; bury you; hunt you down; gut you; skin you; smash you; make you suffer; make you pay; make you bleed; make you regret; beat the shit out of; beat the crap out of; kick your ass; kick your teeth; kick your head; come after you; rip you apart; tear you apart; run you over; throw you out of the window; throw you off
dich um; dich tot; dich fertig; dich zusammen; dich schlagen; dich umbringen; dich toten; dir eine rein; dir eine reinhaue; dir eine verpasse; dir die fresse; dir den hals; dir das genick; dir weh; dich abstechen; schlag dich; matar; matarte; partir la cara; partirte la cara; romper la cara; romperte; reventar; reventarte; pegarte; apunalar; hacer dano; te tuer; te casser la gueule; te peter; te frapper; t'etrangler; te buter; te defoncer; te crever; te matar; te quebrar; te arrebentar; te bater; te socar; te encher de porrada; acabar com voce; 杀了你; 打死你; 弄死你; 揍你; 砍死你; 打断你; 宰了你; 杀你; 殺す; 殺してやる; ぶっ殺す; 殴る; 殴って; ぶん殴る; 刺す; 潰す
"""
BREAK_YOUR = """
break your; smash your; crush your; snap your; cut your; slit your; rip your; tear your; knock your; bash your; punch your; kick your; cut off your; rip out your; tear out your; chop off your; burn your; twist your; brich dir; breche dir; breche deine; poliere dir; einschlagen; romperte; romperte la; romperte los; partirte; cortarte; te casser; te briser; casser tes; te couper; quebrar teus; quebrar seus; quebrar sua; quebrar tua; cortar sua; 打断你的; 打烂你的; 撕烂你的; 砍掉你的; へし折る; 叩き折る
"""
BODY_PART = """
finger*; leg*; neck; jaw; face; nose; arm*; teeth; tooth; bone*; head; skull; throat; knee*; kneecap*; hand*; spine; back; rib*; eye*; house; fucking; hals; genick; beine; knochen; finger; zahne; nase; cara; piernas; dientes; cuello; dedos; brazos; jambes; dents; cou; doigts; bras; nez; pernas; dentes; pescoco; dedos; bracos; nariz; 腿; 手; 脖子; 牙; 骨头; 嘴; 足; 腕; 首; 骨; 指
"""
#: Where somebody ends who is threatened.
END = """
on a stretcher; in a stretcher; in a body bag; in a coffin; in a wheelchair; in a hospital bed; in intensive care; in an ambulance; in a grave; in the morgue; six feet under; without teeth; without your teeth; missing teeth; in a ditch; regret the day; regret being born; regret you were born; wish you were never born; wish you were dead; im sarg; im grab; auf einer trage; en una camilla; en un ataud; bajo tierra; sur un brancard; dans un cercueil; numa maca; num caixao
"""
FUTURE_YOU = """
you will; youll; you ll; you are going to; youre going to; you are gonna; you will be; you will end; you will leave; you will find; put you; send you; land you; you end up; you leave; wirst du; landest du; du landest; acabaras; vas a acabar; tu vas finir; tu finiras; voce vai acabar; voce vai parar; vais acabar
"""
#: That somebody should not be there, and that others would like it.
ABSENCE = """
better off without you; better off without him; better off without her; better off if you; notice if you vanished; notice if you died; notice if you disappeared; notice if you were gone; notice if you were dead; notice if you quit; notice if you never came back; should never have been born; shouldnt have been born; should have been aborted; have aborted you; better off dead; world without you; waste of oxygen; waste of space; waste of skin; waste of air; waste of breath; waste of flesh; waste of life; waste of a human; waste of human; waste of a chair; waste of carbon; niemand wurde dich vermissen; keiner wurde dich vermissen; ohne dich besser; verschwendung von sauerstoff; nadie te echaria de menos; nadie te extranaria; mejor sin ti; desperdicio de oxigeno; personne ne te regretterait; mieux sans toi; gaspillage d'oxygene; ninguem sentiria sua falta; ninguem sentiria a tua falta; melhor sem voce; desperdicio de oxigenio; 没人会想你; 没有你更好; 浪费空气; 浪费粮食; いない方がいい; 生きる価値がない; 生まれてこなければ
"""
EVERYONE = """
most of us; all of us; everyone; everybody; we; we all; they all; the whole team; the team; the whole lab; half the lab; alle; wir; todos; tout le monde; todo mundo; 大家; 所有人; みんな
"""
SCORN = """
laugh about you; laugh at you; laughs at you; laughs about you; laughing at you; laughing about you; make fun of you; makes fun of you; mock you; mocks you; hate you; hates you; despise you; despises you; cant stand you; can not stand you; talk behind your back; would cheer; would celebrate; would throw a party; would be relieved; would be glad; would be happier; lachen uber dich; lacht uber dich; hasst dich; verachtet dich; se rie de ti; se rien de ti; te odia; te odian; rit de toi; se moque de toi; te deteste; ri de voce; rimos de voce; te odeia; odeiam voce; 笑话你; 嘲笑你; 讨厌你; 恨你; お前を笑って; お前を嫌って; お前が嫌い
"""
NOBODY = """
nobody; no one; noone; not a single; no soul; none of us; not one of us; niemand; keiner; nadie; personne; ninguem; 没人; 没有人; 誰も
"""
LIKES = """
likes you; wants you; want you here; respects you; respect you; would miss you; will miss you; would care if you; cares about you; mag dich; wurde dich vermissen; te quiere; te soporta; te extranaria; t'aime; te regretterait; gosta de voce; sentiria sua falta; 喜欢你; 会想你; お前なんか; お前のこと
"""
MOTHER = """
your mother; your mom; your mum; your mama; your parents; your father; your family; deine mutter; deine eltern; tu madre; tus padres; ta mere; tes parents; sua mae; tua mae; seus pais; 你妈; 你爸; 你父母; お前の母親; お前の親
"""
SHAME = """
ashamed; be so ashamed; embarrassed; regret; regrets; disappointed; should have swallowed; dropped you; is a whore; is so fat; schamt; schamen; verguenza; avergonzada; honte; vergonha; envergonhada; 羞耻; 丢脸; 后悔; 恥
"""
PEOPLE_LIKE = """
people like you; someone like you; somebody like you; idiots like you; your kind of people; leute wie du; menschen wie du; gente como tu; les gens comme toi; gente como voce; 你这种人; お前みたいな
"""
WRONG = """
die; ruin; ruins; ruined; destroy; disgust; cancer; plague; schuld; culpa; honte; 恶心; 原因だ; 迷惑
dies; dead; disgusting; sterben; scheitern; mueren; fracasan; meurent; echouent; morrem; fracassam; 倒霉; 失败; だめになる
"""
#: Groups of people that hatred is aimed at.
GROUP = """
immigrant*; migrant*; foreigner*; refugee*; asylum seeker*; women; female*; gay*; gay people; homosexual*; lesbian*; queers; transgenders; trans people; transsexual*; jewish people; blacks; black people; whites; white people; asian people; chinese people; the chinese; turks; roma people; disabled people; the disabled; handicapped people; autistic people; autist*; old people; the elderly; poor people; homeless people; of that faith; of this faith; that faith; that religion; single mothers; feminist*
auslander; migranten; fluchtlinge; frauen; weiber; schwule; schwulen; lesben; juden; muslime; moslems; christen; schwarze; schwarzen; behinderte; behinderten; zigeuner; turken; araber; polen; asylanten; alte leute; alten leute; glaubige; transen; homosexuelle; leute aus dem
inmigrantes; extranjeros; refugiados; mujeres; homosexuales; judios; musulmanes; negros; gitanos; indios; viejos; discapacitados; arabes; chinos; mexicanos; cristianos; los del sur; la gente del
immigres; etrangers; refugies; femmes; juifs; musulmans; noirs; arabes; homosexuels; roms; gitans; handicapes; vieux; migrants; chinois; chretiens; gays; les gens du
imigrantes; estrangeiros; refugiados; mulheres; homossexuais; judeus; muculmanos; negros; pretos; indios; ciganos; velhos; deficientes; arabes; chineses; cristaos; gays; gente do
移民; 外地人; 外国人; 难民; 女人; 同性恋; 犹太人; 穆斯林; 黑人; 残疾人; 老人; 乡下人; 少数民族; 基督徒; 難民; 女ども; ゲイ; 同性愛者; ユダヤ人; 黒人; 障害者; 年寄り; 朝鮮人; 中国人; イスラム教徒
christians; hindus; jews; muslims; asians; arabs; africans; mexicans; indians; russians; catholics; buddhists; atheists; believers; people from the south; people from the north; people from the east; people from the west; southerners; northerners; easterners; westerners; people of that faith; people of that religion; those people; you people; people of color
"""
#: Words for groups that may stand for things as well, so that more has to be said of them.
WEAK_GROUP = """
old ones; the old; the poor; that lot; their kind; this kind; that kind; boomers; die alten; los viejos; les vieux; os velhos
"""
#: That all was well before somebody came, or would be without.
BEFORE = """
better off if; better off without; fine before; great before; good before; better before; fine until; great until; good until; better until; gut bevor; besser bevor; mejor antes de que; bien hasta que; mieux avant que; melhor antes
"""
#: Names of groups that degrade by themselves.
SLUR = """
faggot*; fag*; dyke*; tranny; trannies; nigger*; nigga*; kike*; spic*; chink*; raghead*; towelhead*; paki*; gook*; wetback*; slant heads; slantheads; slant eyes; slanteyes; mudskin*; mud skins; sand rats; sandrats; sand nigger*; camel jockey*; cave people; cave dwellers; savages; cripple*; retards; gypsies; gypsy; infidels; heathens; filthy faith; dirty faith; filthy religion; kanaken; kanake; neger; kruppel; schwuchtel; schwuchteln; kummelturken; schlitzaugen; maricas; maricones; sudacas; moros; moracos; panchitos; bougnoules; negres; bicots; youpins; pedes; tarlouzes; viados; bichas; crioulos; sapatao; 鬼子; 黑鬼; 娘炮; 死基佬; 棒子; チョン; オカマ; ホモ野郎
half breed*; halfbreed*; mongrel*; untouchables; mestizos de mierda; mischlinge; rassenschande
"""
#: That a group is something, and what it is said to be.
ARE = """
are; are all; are just; are nothing but; are like; are a; are the; they are; they re; theyre; sind; sind alle; sind nur; sont; sont tous; sont de la; sont des; ce sont; son; son todos; son una; son unos; sao; sao todos; sao uma; sao uns; 都是; 就是; 是; 全是; は; はみんな; みんな; という
"""
VERMIN = """
vermin; parasite*; rat*; cockroach*; animal*; beast*; filth; filthy; scum; plague; subhuman*; inferior; liar*; born liars; thieve*; thief; criminal*; rapist*; terrorist*; savage*; pig*; pest*; trash; garbage; dirt; dirty; lazy; monkey*; ape*; cancer; insect*; locust*; leech*; maggot*; retarded; degenerate*; mentally ill; perverts; worthless; useless; less human; not human; not people
ungeziefer; parasiten; ratten; abschaum; untermenschen; dreckig; faul; verlogen; minderwertig; pest; tiere; schmarotzer; kriminelle; diebe; lugner; schweine; dreck; affen; plaga; ratas; parasitos; escoria; ladrones; inferiores; sucios; animales; criminales; vagos; mentirosos; basura; cerdos; cucarachas; vermine; rats; parasites; racaille; voleurs; sales; inferieurs; animaux; menteurs; criminels; cafards; ordures; feignants; volent; volent tous; praga; ratos; parasitas; escoria; ladroes; sujos; inferiores; nojentos; vermes; animais; lixo; preguicosos; mentirosos; baratas; 害虫; 寄生虫; 老鼠; 劣等; 肮脏; 小偷; 人渣; 垃圾; 畜生; 骗子; ゴキブリ; 劣っている; 汚い; 泥棒; ゴミ; クズ; 嘘つき; 犯罪者; けだもの
a disease; the disease; alles ungeziefer; alles abschaum; todos sujos; todos ladroes; todos ladrones; tous des voleurs
"""
#: What is done, or is to be done, with a group as a whole, before its name.
AGAINST = """
back to their; back where they; send back; out of the country; get rid of; got rid of; rid of all; wipe out; wipe them out; exterminate; deport; cleanse; purge; gas the; kill all; hang all; burn all; shoot all; never trust; dont trust; do not trust; can not trust
cant trust; refuse to share; refuse to work with; refuse to sit; will not work with; wont work with; we hate; despise; hired one of; hired another; typical of; typical for; abschieben; vergasen; typisch; vertraue nie; ich hasse; zuruck nach; expulsar; odio a; odio; no confies
tipico de; je deteste; je hais; expulser; typique des; odeio; detesto; tipico de; nao confie; 赶走; 消灭; 杀光; 恨; 追い出せ; 殺せ; 信用するな; 大嫌い; i hate; i hate all; we hate all; they hate all; back to the hole
back to the desert; back to the jungle; back to their; back to where; rid of them; auslander raus; out of our country; out of our lab; what do you expect from; thats what you get; this is what you get
"""
#: What is said of a group as a whole, behind its name.
SAID_OF = """
in their blood; in their genes; in their nature; belong in a; belong in the kitchen; belongs in the kitchen; belong in the zoo; belong in a cage; belong in camps; dont belong; do not belong; cant do; can not do; cant think; not made for; too stupid for; too stupid to; breeding; stopped breeding; stop breeding; breed like; didnt exist
did not exist; back to their; back where they; out of the country; should not be allowed; shouldnt be allowed; should never be allowed; not be allowed; should not vote; should be banned; should be deported; should be gassed; should be shot; should be sterilized; should be locked; should be exterminated; exterminate; deport; ruined; ruin everything
invaded; so typical; stink; always steal; lie and steal; cant be trusted; to blame; are to blame; aus dem land; abschieben; vergasen; an den herd; gehoren nicht; gehoren in die; haben hier nichts verloren; nichts verloren; typisch; stehlen; que se vuelvan; vuelvan
vuelvanse; fuera de; expulsar; expulsados; a la cocina; roban; qu'ils rentrent; rentrez chez; volent; a la cuisine; expulser; deviam ser; deveriam ser; expulsos; voltem para; na cozinha; roubam; 赶出去; 应该被; 滚回; 滚出; 赶走
不配; 国へ帰れ; 帰れ; 出て行け; 追い出せ; 消えろ; 殺せ; 入れるな; back to the hole; back to the desert; back to the jungle; back to their; back to where; raus aus; jagen; devraient etre expulses; deberian irse; out of our country; out of our lab; smell like; all smell; stink like
versauen; ruinan todo; ruinent tout; estragam tudo; 毁了; 台無し
"""
#: Parts of the body and states that are named to desire somebody, and acts that are meant.
EROTIC_PART = """
tits; titties; boobs; breast*; pussy; cunt; cock; dick; penis; vagina; ass; arse; butt; thigh*; nipple*; panties; underwear; naked body; nude body; nudes; nude; naked; naked pics; titten; bruste; muschi; schwanz; hintern; arsch; hoschen; nackten; nackte; brustwarzen; schenkel; tetas; pechos; culo; polla; cono; pezones; muslos; desnudos; desnuda; bragas; seins; nichons; cul; fesses; bite; chatte; tetons; culotte; nue; nues; peitos; seios; bunda; buceta; pau; rola; coxas; pelada; pelados; calcinha; mamilos; 胸; 奶子; 屁股; 大腿; 裸体; 裸照; 下面; 乳房; 内裤; おっぱい; 尻; 太もも; 裸; 乳首; 下着; あそこ
"""
OBSCENE = """
fuck; fucked; fucks; fucking; fucking in; banged; bangs; gets banged; gets screwed; gets laid; shagged; shag; blowjob*; handjob*; cum; cums; orgasm*; horny; deepthroat; anal; masturbat*; jerk off; jerked off; wank; gangbang; threesome; striptease; doggy style; on my lap; on top of me; in my bed; lick; licking; suck; sucking
gets laid; get laid; gets nailed; got nailed; has sex; had sex; having sex
"""
#: Acts with an object: somebody.
TAKE_YOU = """
fuck you; ride you; bend you; bend you over; lick you; strip you; undress you; bang you; screw you; shag you; spank you; mount you; sleep with you; make love to you; have sex with you; make you come; make you cum; make you moan; make you scream; take you from behind; pin you; rip your clothes off; tear your clothes off; take your clothes off; take off your clothes; have you naked; see you naked; want you naked; get you naked; fuck him; fuck her; lick her; bend her over
dich ficken; dich vogeln; vogeln; ficken; dich nageln; dich bumsen; dich flachlegen; flachlegen; mit dir schlafen; dich ausziehen; dich lecken; bumsen; durchnehmen; follarte; cogerte; desnudarte; tocarte; lamerte; acostarme contigo; hacerte mia; hacerte el amor; te follo; te baiser; te sauter; te lecher; te deshabiller; coucher avec toi; te faire jouir; te toucher; te comer; te foder; te lamber; te despir; transar com voce; transar contigo; dormir com voce; te chupar; te comer gostoso; 跟你做爱; 和你做爱; 操你; 上你; 睡你; 脱光你; 摸你; 舔你; 做爱; セックスし; 抱いてやる; お前を抱; 犯す; 脱がせ; 舐め; やらせろ; ヤらせろ; 裸にして
脱光你; 抱く; 裸にして抱; touch you all over; feel you up
"""
DESIRE = """
want to; wants to; wanted to; wanna; i wanna; i would love to; id love to; i am going to; gonna; going to; let me; i need to; i could; i cant wait to; dying to; dreaming of; imagine; imagining; i dream of; would you; how he; how she; tonight; quiero; quisiera; me gustaria; tengo ganas de; voy a; ganas de; je veux; je voudrais; j'ai envie de; envie de; laisse moi; je vais; quero; queria; vontade de; vou; adoraria; deixa eu; ich mochte; ich wurde gern; lass mich; heute nacht; 我想; 想; 我要; 今晚; 让我; 今夜; させろ; しよう
i want to; i will; i ll; ich will; したい; 抱きたい; ill; will
"""
SHOW = """
send me; send; show me; show; show us; picture of; pictures of; photo of; photos of; pic of; pics of; video of; let me see; i want to see; wanna see; thinking about; thinking of; think about; think of; dream about; dreaming about; dreaming of; staring at; looking at; stare at; cant stop thinking about; fantasize about; imagine; squeeze; kiss; lick; suck; zeig mir; zeig; schick mir; schick; ich denke an; bild von; fotos von; mandame; manda; ensename; muestrame; fotos de; foto de; pienso en; montre moi; montre; envoie moi; envoie; photos de; photo de; je pense a; manda; mande; me manda; mostra; mostra os; me mostra; fotos dos; fotos da; foto da; penso em; 给我看; 发给我; 让我看看; 看看; 想着; 見せ; 見せろ; 見せて; 送れ; 送って; 触らせ; 考えて
"""
HIS_HER = """
her; his; him; she; he; la; le; ihr; ihre; son; sa; ses; dela; dele; 她; 他; 彼女
"""
WEAR = """
wear; wearing; wears; put on; in that; in your; in those; love that; love your; that; your; trag; ponte; mets; veste; usa
"""
GARMENT = """
tight skirt; short skirt; mini skirt; miniskirt; tight dress; short dress; tight jeans; tight pants; tight leggings; tight shorts; tight blouse; tight top; low cut top; lace underwear; engen rock; kurzen rock; falda corta; falda apretada; vestido apretado; jupe courte; jupe serree; robe moulante; saia curta; saia justa; vestido justo
"""
MOAN = """
moan*; moans; moaning; screams in bed; gasp*; pant*; stohnt; gime; gemit; geme; 呻吟; 喘ぐ
"""
AROUSED = """
i was hard; i was so hard; i got hard; im so wet; i was horny; turned me on; turns me on; i touch myself; i touched myself
turn me on; it turned me on
"""
#: Set phrases that are explicit or advances by themselves.
EXPLICIT = """
send nudes; send me nudes; your nudes; nudes of you; dick pic*; sex cams; sex cam; live sex; cam girls; camgirls; hot singles; hot girls; uncensored porn; hardcore porn; free porn; porn videos; xxx videos; xxx video; sex videos; sex video; sex tape*; hot nudes; free nudes; selling nudes; onlyfans; sit on my face; spread your legs; open your legs; touch yourself; so horny; horny for; i am horny; hard for you; wet for you; got me hard; makes me hard; makes me wet; get me hard; wet pussy; hard cock; wet ass; wet hole; big cock; big tits; nice tits; nice ass; we fucked; we banged; we screwed; we had sex; take it from behind; takes it from behind; took it from behind; until you scream; til you scream; until you moan; until you come; sleep your way; slept her way; slept his way; sleep with me; come to my bed; join me in bed; all over your tits; all over your face; swallow my
blas mir einen; lutsch meinen; geile titten; geiler arsch; setz dich auf mein; pornos; chupame la; comeme la; mamame; ponte de rodillas; videos porno; suce moi; suce ma; videos porno; film porno; a poil; chupa meu; chupa minha; senta no meu; senta na minha; videos porno; manda nudes; 发裸照; 裸聊; 约炮; 一夜情; 色情视频; 口交; 吹箫; セックスしよう; エッチしよう; フェラ; ヌード写真; 裸の写真; 中出し
"""
#: Harmless: swearing at things or oneself, technical words, rules quoted. What they cover doesn't count.
HARMLESS = """
stupid me; silly me; dumb me; my stupid; my dumb; i am an idiot; im an idiot; i was an idiot; i am such an idiot; im such an idiot; i was such an idiot; i was such a moron; i was such a fool; i feel so stupid; i was so stupid; i feel like an idiot; i am a moron; i am stupid; im stupid; what an idiot i am; how stupid of me; idiot that i am; i idiot; call me an idiot; call myself an idiot; i was stupid; so stupid of me; i hate myself; i hate my; i hate this; i hate it; i hate when; i hate that; kill me now; kill me; i want to die; i could die; shoot me; shoot me an email; shoot me a message; shoot me a mail
holy shit; oh shit; no shit; shit happens; bull shit; bullshit; damn it; goddamn it; oh fuck; fuck this; fuck that; fuck it; fuck me; for fucks sake; what the fuck; what the hell; why the fuck; this fucking; the fucking; these fucking; that fucking; my fucking; so fucking; is fucking; hell of a; one hell of; fuck up the; fucked up the; fucked up; screwed up; screw up; piece of shit code; piece of shit script; piece of shit scheduler; piece of shit software; piece of shit server; piece of shit cluster; piece of crap code; the hell out of; hell no; bloody hell
dumb terminal*; dumb question*; stupid question*; idiot proof; fool proof; foolproof; naked eye; naked mole rat*; naked singularity; naked dna; naked domain; naked option*; nude mice; nude mouse; nude palette; cock valve*; stop cock*; stopcock*; cock and bull; weather cock; moby dick; dick and; sex hormone*; sex ratio*; sex chromosome*; sex difference*; sex as a; sex and age; age and sex; same sex; sex specific; sex linked; opposite sex; sex of the; sexual dimorphism; sexual reproduction; sexual harassment; sexual remarks; sexual content; sexual health; sexual assault; breast cancer; breast tissue; breast milk; breast tumor*; breast tumour*; breast implant*; breast carcinoma; chicken breast*; anal fistula; anal canal; cum laude; screw cap*; wet lab; wet bench; wet weight; wet ice; wet mount; i was hard at; i was hard on; i was hard to; i was hard pressed; hard at; hard cutoff; hard drive*; hard disk*; hard coded; hard code; hard to; hard limit; hard reset; hard copy; hard work; hard stop; hard link*; hot spot*; hot spot; hot swap; hot fix; hot plate; hot key*; hot path; hot standby; strip plot; strip the; strip off; strip out; strip white space; test strip*; kiss principle; ass backwards; half assed; bad ass; badass; dirty read*; dirty flag; dirty page*; dirty bit; dirty data; dirty glass*; lazy load*; lazy evaluation; master slave; slave replica*; dead letter; legs of; head of; back of
you killed it; killed it with; you rock; you beast; you legend; you genius; in a good way; is a beast; kill the process; kill the pod; kill the job; kill the idiot; kill switch; kill signal; kill your process; kill your job*; kill child*; kill children; kill all jobs; kill all processes; kill zombie*; orphaned child*; child process; killed by; burn your disk; break your build; break your code; break your back over; cut your losses; knock your socks; find you a; find you the; find you in; beat you to it; hit you up; do you; feel you; ruin your day; touch your toes
rats and mice; mice and rats; lab rat*; rats were; rat liver; rat plasma; rat model*; in rats; dog plasma; beagle dog*; guinea pig*; pig liver; pigs were; parasite protease*; parasite load; parasites were; malaria parasite*; cancer cell*; trash folder; trash can; garbage collector; garbage collection; garbage in; black box; white list; black list; waste container; waste bin; waste stream; waste disposal; hazardous waste; solvent waste; waste of time; waste of compute; waste of money; waste of memory; fraud detection; liar paradox; troll detection; slug line; url slug; slug of the; monkey patch*; monkey test*; code monkey*; snake case; python snake; code smell*; smoke test*; watch dog; watchdog; rubber duck; joke aside; jokes aside; just a joke; just joking; donkey engine; dog food; dogfood*; cow method; copy on write cow; native american*; native speaker*; native code; native ligand*; native pose*; native contact*; native structure*; native state*; native protein*; native conformation*; pole figure*; female rat*; female mice; male and female; females and males; males and females; men and women; women and men; pregnant women; women in science; in women; healthy women; turks and caicos; spic and span; chink in; dyke swarm*; paki stan; fag end
no insults; insults are not; are not allowed; do not insult; is not tolerated; are not tolerated; not acceptable; will be removed; will be deleted; will be banned; is forbidden; are forbidden; is prohibited; are prohibited; code of conduct; report abuse; hate speech; insults slurs; insults or; slurs or; like this are; words like; phrases like; such as; for example the word; the word; the term; is an insult; is a slur; keyword; key word; regex; blocklist
verdammt noch mal; verdammte scheisse; scheiss scheduler; scheiss; so ein mist; mist; verflixt; ich idiot; ich depp; ich trottel; ich bin ein idiot; ich bin so dumm; brustkrebs; sexualhormon*; geschlechtshormon*; prozess toten; nackte dna
joder que; que mierda de; mierda de cola; maldita cola; soy idiota; soy un idiota; que tonto soy; que idiota soy; cancer de mama; hormona sexual; hormonas sexuales; matar el proceso; mata el proceso; mate el proceso; matar el job
putain quel; putain de serveur; putain; bordel; merde la; merde le; merde j; quel con je suis; quel idiot je suis; je suis bete; je suis idiot; je suis con; cancer du sein; tuer le processus; tue le processus; tuez le processus; hormone sexuelle; hormones sexuelles; pas de probleme; pas de souci
caramba; que merda de; merda de fila; merda a fila; porra a fila; porra; que burro eu sou; sou burro; sou um idiota; que idiota eu sou; cancer de mama; hormonio sexual; matar o processo; mate o processo; mata o processo
该死的队列; 该死; 杀掉进程; 杀死进程; 结束进程; 我真笨; 我真蠢; 我是白痴; 我真是个白痴; 乳腺癌; 性激素; くそまた; プロセスを殺して; 俺はバカ; 私はバカ; 私は馬鹿; 自分がバカ; 乳がん; 性ホルモン; 雌ラット
to hell and back; call it a; called it a; i call it; would call it
"""

#: Endings that a star stands for.
ENDINGS = ("", "s", "es", "ed", "ing", "ion", "y")

CLEAN = """
clean the; clean our; clean this; cleanse the; cleanse our; purge the; purge our; free the; free our; rid the; rid our; saubern; limpiar el; limpiar la; nettoyer le; nettoyer la; limpar o; limpar a
"""
OF_ALL = """
of all; of those; of these; of every; of the; from all; from those; von allen; von diesen; de todos; de esos; de tous; de ces; desses; dessas
"""
NO_WONDER = """
of course it; no wonder; no surprise; thats why; that is why; thats what; this is what; kein wunder; klar dass; no me extrana; claro que; pas etonnant; claro que; nao me admira; 难怪; 怪不得; 道理で
"""
THEY_LET = """
they let; they hired; they had; we let; you let; who let; letting; hiring; hired; haben sie; contrataron; dejaron; ils ont pris; ils ont laisse; contrataram; deixaram; 让; 招了; 雇った
"""
WITHOUT = """
no more; pas de; plus de; keine; no quiero; sem; nao quero; 不要; いらない
"""

#: Classes that have to occur in a sentence for anything to be found, with their weights.
CORE = {
    "insult": (INSULT, 0.6), "demeaning": (DEMEANING, 0.5), "adjective": (ADJECTIVE, 0.5), "intensifier": (INTENSIFIER, 0.4), "dismiss": (DISMISS, 1.0), "harm": (HARM, 1.0), "fate": (FATE, 0.6),
    "do_to_you": (DO_TO_YOU, 0.6), "break_your": (BREAK_YOUR, 0.4), "end": (END, 0.6), "absence": (ABSENCE, 1.0), "scorn": (SCORN, 0.6), "likes": (LIKES, 0.6),
    "mother": (MOTHER, 0.5), "people_like": (PEOPLE_LIKE, 0.6), "refuse": (REFUSE, 0.5), "slur": (SLUR, 0.8), "group": (GROUP, 0.5), "weak_group": (WEAK_GROUP, 0.4), "erotic_part": (EROTIC_PART, 0.5),
    "obscene": (OBSCENE, 0.5), "take_you": (TAKE_YOU, 0.7), "garment": (GARMENT, 0.5), "aroused": (AROUSED, 0.7), "explicit": (EXPLICIT, 1.0),
}
#: Classes that are looked up only in sentences with a core class.
BESIDE = {
    "you": (YOU, 0.4), "your": (YOUR, 0.4), "is": (IS, 0.4), "you_are": (YOU_ARE, 0.5), "degree": (DEGREE, 0.3), "wish": (WISH, 0.4), "will": (WILL, 0.4),
    "body_part": (BODY_PART, 0.4), "future_you": (FUTURE_YOU, 0.4), "everyone": (EVERYONE, 0.4), "nobody": (NOBODY, 0.4), "shame": (SHAME, 0.5), "wrong": (WRONG, 0.4),
    "excuse": (EXCUSE, 0.5), "call": (CALL, 0.5), "award": (AWARD, 0.4), "are": (ARE, 0.1), "vermin": (VERMIN, 0.5), "against": (AGAINST, 0.5), "said_of": (SAID_OF, 0.5), "without": (WITHOUT, 0.1), "before": (BEFORE, 0.5), "clean": (CLEAN, 0.3), "of_all": (OF_ALL, 0.3), "no_wonder": (NO_WONDER, 0.3), "they_let": (THEY_LET, 0.3), "desire": (DESIRE, 0.3),
    "show": (SHOW, 0.3), "his_her": (HIS_HER, 0.3), "wear": (WEAR, 0.3), "moan": (MOAN, 0.5), "thing": (THING, 0.0),
}

#: Classes in order, with the most words that may stand between one and the next.
PATTERNS = (
    ("dismiss",), ("harm",), ("absence",), ("explicit",),
    ("is", 3, "insult"), ("you_are", 3, "insult"), ("you", 1, "insult"), ("insult", 2, "you"), ("adjective", 0, "insult"), ("intensifier", 0, "insult"), ("insult", 0, "award"),
    ("you_are", 3, "demeaning"), ("you", 0, "adjective", 0, "demeaning"), ("you", 0, "intensifier", 1, "demeaning"), ("is", 1, "adjective", 0, "demeaning"), ("you_are", 1, "adjective"), ("you_are", 3, "refuse"),
    ("adjective", 0, "excuse"), ("call", 3, "demeaning"), ("degree", 1, "adjective", 1, "degree"), ("degree", 0, "insult", 4, "you"), ("degree", 0, "insult", 0, "degree"),
    ("wish", 2, "fate"), ("will", 3, "do_to_you"), ("will", 3, "break_your", 1, "body_part"), ("future_you", 6, "end"),
    ("everyone", 3, "scorn"), ("nobody", 3, "likes"), ("mother", 6, "shame"), ("mother", 4, "insult"), ("people_like", 8, "wrong"), ("people_like", 8, "insult"), ("people_like", 8, "adjective"),
    ("group", 4, "are", 2, "vermin"), ("adjective", 0, "group"), ("group", 6, "said_of"), ("against", 4, "group"), ("without", 3, "group", 8, "vermin"), ("group", 8, "vermin", 3, "vermin"), ("clean", 3, "of_all", 1, "group"), ("no_wonder", 4, "they_let", 2, "group"), ("before", 2, "group"), ("before", 2, "slur"), ("before", 2, "weak_group", 4, "said_of"),
    ("weak_group", 4, "said_of", 6, "said_of"), ("weak_group", 4, "are", 2, "vermin", 6, "said_of"), ("against", 4, "weak_group", 4, "vermin"), ("clean", 3, "of_all", 1, "weak_group"),
    ("no_wonder", 4, "they_let", 2, "weak_group"),
    ("slur", 8, "said_of"), ("against", 4, "slur"), ("they_let", 3, "slur"), ("clean", 3, "of_all", 1, "slur"), ("slur", 3, "vermin"), ("slur", 6, "are", 2, "vermin"), ("without", 3, "slur", 8, "vermin"), ("adjective", 1, "slur"), ("you", 2, "slur"), ("is", 2, "slur"), ("you_are", 2, "slur"), ("slur", 2, "you"),
    ("show", 3, "your", 3, "erotic_part"), ("desire", 3, "take_you"), ("take_you", 5, "desire"), ("take_you", 6, "take_you"), ("desire", 3, "obscene", 1, "you"), ("desire", 5, "your", 2, "erotic_part"),
    ("his_her", 1, "erotic_part", 6, "obscene"), ("obscene", 6, "his_her", 1, "erotic_part"), ("wear", 1, "garment", 14, "aroused"), ("aroused", 4, "you"), ("moan", 10, "obscene"),
    ("wear", 1, "garment", 12, "show"),
)

#: Endings of names of peoples, and of words for professions and things that end alike.
PEOPLES, NO_PEOPLES = ("ians", "eans"), """
technicians; physicians; clinicians; librarians; statisticians; mathematicians; politicians; custodians; guardians; medians; radians; gaussians; hessians; jacobians; hamiltonians; lagrangians; laplacians; musicians; electricians; magicians; historians; veterinarians; dieticians; theoreticians; beans; means; oceans; leans; cleans; jeans; deans; comedians; civilians; amphibians; meridians; pedestrians; vegetarians; volunteers
"""


def entries(text: str) -> list[str]:
    """The entries of a class."""
    return [e.strip() for line in text.strip().splitlines() for e in line.split(";") if e.strip()]
